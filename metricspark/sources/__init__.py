"""Sources: exposition text, JSON label sets, pod snapshots."""
