"""weftline engine."""
