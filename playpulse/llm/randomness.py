"""Randomness tests of a token within its inferred encoding."""

from __future__ import annotations

import math
import re

#: Encodings from the narrowest alphabet to the widest; symbols in the order of their values.
ENCODINGS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "BASE36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
VALUES = {name: {c: i for i, c in enumerate(symbols)} for name, symbols in ENCODINGS.items()}
FITS = [(name, re.compile(f"[{re.escape(symbols)}]+")) for name, symbols in ENCODINGS.items()]
MIXED = re.compile("(?=.*[0-9])(?=.*[A-Za-z])|(?=.*[a-z][A-Z])(?=.*[A-Z][a-z])")
PER_BIN = 5  # expected symbols of a chi-squared bin


def encoding_of(token: str) -> str | None:
    """The narrowest encoding that holds the token; None for numbers, words and names in one case."""
    if not MIXED.match(token):
        return None
    return next((name for name, fits in FITS if fits.fullmatch(token)), None)


def chi2_tail(x: float, df: int) -> float:
    """Upper tail of the chi-squared distribution (regularized incomplete gamma function)."""
    a, x = df / 2, x / 2
    if x <= 0:
        return 1.0
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > abs(total) * 1e-15:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1 - total * scale)
    b, tiny = x + 1 - a, 1e-300
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 500):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b or tiny)
        c = b + an / c or tiny
        h *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return min(1.0, h * scale)


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def uniformity(values: list[int], size: int) -> float:
    """Chi-squared test of equal symbol frequencies, neighbouring symbols binned so that each bin expects enough."""
    n = len(values)
    bins = max(2, min(size, n // PER_BIN))
    counts, width = [0] * bins, [0] * bins
    for v in range(size):
        width[v * bins // size] += 1
    for v in values:
        counts[v * bins // size] += 1
    stat = sum((c - n * w / size) ** 2 / (n * w / size) for c, w in zip(counts, width, strict=True))
    return chi2_tail(stat, bins - 1)


def runs_test(values: list[int], size: int) -> float:
    """Wald-Wolfowitz test of the runs above and below the middle of the alphabet."""
    above = [2 * v >= size for v in values]
    n, m = sum(above), len(above) - sum(above)
    if not n or not m or n + m < 3:
        return 2.0 ** (1 - len(above))  # one side only
    runs = 1 + sum(a != b for a, b in zip(above, above[1:], strict=False))
    mean = 1 + 2 * n * m / (n + m)
    var = 2 * n * m * (2 * n * m - n - m) / ((n + m) ** 2 * (n + m - 1))
    return normal_two_sided((runs - mean) / math.sqrt(var)) if var > 0 else 1.0


def serial_correlation(values: list[int], size: int) -> float:
    """Test of the correlation between neighbouring symbols, against the alphabet's own mean and variance."""
    mid, var = (size - 1) / 2, (size * size - 1) / 12
    pairs = len(values) - 1
    total = sum((a - mid) * (b - mid) for a, b in zip(values, values[1:], strict=False))
    return normal_two_sided(total / (var * math.sqrt(pairs)))


def randomness(token: str, encoding: str) -> float:
    """Fisher's combination of the three tests: about uniform for random tokens, near 0 for others."""
    of, size = VALUES[encoding], len(ENCODINGS[encoding])
    values = [of[c] for c in token]
    ps = [uniformity(values, size), runs_test(values, size), serial_correlation(values, size)]
    return chi2_tail(-2 * sum(math.log(max(p, 1e-300)) for p in ps), 2 * len(ps))
