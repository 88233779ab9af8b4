"""Set-based operators over samples and dimensions."""
