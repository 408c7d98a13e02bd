"""quillstream."""
