"""Writers for chunk documents and vectors."""
