"""The rules again in plain Python, to check small inputs by."""

import math
import re
from collections import Counter

PIECE = re.compile(r"[^ \t\n\x0b\f\r,.;:?!\"()\[\]{}_-]+")


def words(text):
    return [piece.lower() for piece in PIECE.findall(text) if re.fullmatch("[a-zA-Z]+", piece)]


def letters(text):
    return [char.lower() for char in text if char.isascii() and char.isalpha()]


def ranked(tokens):
    counts = Counter(tokens)
    order = sorted(counts, key=lambda token: (-counts[token], token))
    return [(rank, token, counts[token]) for rank, token in enumerate(order, 1)]


def limits(n):
    return math.ceil(0.05 * n), math.floor(0.475 * n), math.ceil(0.525 * n), math.floor(0.95 * n)


def bands(tokens):
    rows = ranked(tokens)
    popular, low, high, rare = limits(len(rows))
    out = []
    for rank, token, frequency in rows:
        if rank <= popular:
            out.append((rank, token, "popular", frequency))
        elif rank >= rare:
            out.append((rank, token, "rare", frequency))
        elif low <= rank <= high:
            out.append((rank, token, "common", frequency))
    return out
