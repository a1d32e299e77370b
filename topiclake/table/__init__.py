from topiclake.table.lake import LakeTable, ensure_table, list_tables

__all__ = ["LakeTable", "ensure_table", "list_tables"]
