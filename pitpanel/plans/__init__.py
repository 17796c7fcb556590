"""Plans of research windows."""
