"""The operators on streams that do not end."""
