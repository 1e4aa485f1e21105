"""Writers: messages, archive, typed tables, live tables and the registry."""
