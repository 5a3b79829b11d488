"""Reading: catalogs and snapshots, raw documents, and parsers that turn documents into rows."""
