"""weftline operators."""
