"""Writers: raw rows, chunk and batch tables, training sets, metadata and image files."""
