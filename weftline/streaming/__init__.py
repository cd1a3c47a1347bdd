"""weftline streaming."""
