"""Texts for the tests of this folder."""

PROSE = "the old house by the river was sold to a family from the north who kept bees and made honey every summer day".split()


def prose(seed: int, n: int = 60) -> str:
    return " ".join(f"{PROSE[(k * seed + k // 7) % len(PROSE)]}{(k * seed) % 97}" for k in range(n))
