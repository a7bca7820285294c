"""A feed that is not connected.

Bron: none (an example of the contract)
Endpoint: none
"""

from __future__ import annotations


def main() -> int:
    print("not yet implemented")
    return 1


__all__ = ["main"]
