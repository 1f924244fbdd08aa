"""Part of the quillon engine; see README.md."""
