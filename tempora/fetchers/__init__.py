"""Feeds that land snapshots for the readers. Each module has main() -> exit code, __all__, and names its Bron: and Endpoint."""
