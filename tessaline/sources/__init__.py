"""Sources: what exists upstream (discovery over landed bytes), how bytes land (fetching), and the known sources."""
