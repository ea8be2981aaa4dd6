"""Landing: reading and writing documents, files and their ledgers."""
