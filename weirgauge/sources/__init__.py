from weirgauge.sources.tables import publish, read_published, read_table, read_tables, write_messages

__all__ = ["publish", "read_published", "read_table", "read_tables", "write_messages"]
