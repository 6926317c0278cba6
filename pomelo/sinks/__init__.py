"""Writers: create-if-absent tables, partition overwrite, table overwrite, append."""
