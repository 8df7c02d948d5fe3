"""The row-wise part of the engine on file streams."""
