"""Plain-Python statements of the contracts, for comparison on small inputs."""

import hashlib
import re
from collections import Counter

import pytest
import xxhash

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def frame(spark):
    """frame(schema, rows): a DataFrame over several partitions."""

    def make(schema, rows):
        return spark.createDataFrame(list(rows), schema).repartition(3)

    return make


BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return BLANK.findall(text or "")


def quality_counts(text):
    text = text or ""
    w = words(text)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": dup, "n_repeat_words": len(covered)}


def fingerprint(text, size=3):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = words(text)
    if not w:
        return 0
    grams = [" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, distance):
    """{fp: smallest fp of its component}."""
    fps = sorted(set(fps))
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def base_spans(text):
    """The contract's base patterns, stated with their plain regular expressions."""
    text = text or ""
    out = {}
    out["email"] = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out["ip"] = [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
                 if all(int(p) <= 255 for p in m[0].split("."))]

    def luhn(m):
        d = [int(c) for c in m if c.isdigit()]
        return 13 <= len(d) <= 19 and sum(
            x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d))) % 10 == 0

    out["card"] = [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if luhn(m[0])]
    out["phone"] = [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                    if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def base_digest(text):
    spans = base_spans(text)
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, v in spans.items() for a, b in sorted(v)).encode()).hexdigest()


def suffix_cover(streams, depth):
    """Positions that repeats of ``depth`` or more tokens cover, from a real suffix array.

    ``streams``: {page: tokens}. Sorts all suffixes, then takes every maximal interval
    with a common prefix of ``depth`` tokens that holds two or more pages.
    """
    suffixes = sorted(((p, i) for p, t in streams.items() for i in range(len(t) - depth + 1)),
                      key=lambda s: streams[s[0]][s[1]:])
    prefix = [tuple(streams[p][i:i + depth]) for p, i in suffixes]
    covered, a = {p: set() for p in streams}, 0
    for b in range(1, len(suffixes) + 1):
        if b == len(suffixes) or prefix[b] != prefix[a]:
            if len({p for p, _ in suffixes[a:b]}) > 1:
                for p, i in suffixes[a:b]:
                    covered[p].update(range(i, i + depth))
            a = b
    return covered


def masked(text: str | None, listing: str) -> str | None:
    """``text`` with the listed spans replaced by their kind, overlapping ones by the first's."""
    spans = sorted((int(a), int(b), kind) for kind, a, b in (s.split(":") for s in listing.split(",") if s))
    if not spans:
        return text
    out, at = "", 0
    for start, end, kind in spans:
        if start >= at:
            out += text[at:start] + f"[{kind.upper()}]"
        at = max(at, end)
    return out + text[at:]
