"""Small corpora with the awkward cases, and brute-force versions of the operators."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id bigint, key string, blob string, row int, size int"
FOLDER = "/root/testdata/sf0.001"


def prose(n: int, seed: int, vocabulary: int = 3000) -> str:
    """``n`` made-up words, a line break now and then."""
    x, out = seed * 2654435761 % (1 << 32), []
    for k in range(n):
        x = (x * 1664525 + 1013904223) % (1 << 32)
        out.append(f"w{(x >> 8) % vocabulary}" + ("." if k % 11 == 10 else ""))
    return "".join(w + ("\n" if k % 23 == 22 else " ") for k, w in enumerate(out)).strip()


def corpus() -> list[tuple[int, str | None, str | None]]:
    """``(doc_id, text, source)``: nulls, blanks, short, long and repeated texts, copies, near copies, shared passages."""
    long, shared = prose(6000, 5), prose(60, 77)
    rows: list[tuple[int, str | None, str | None]] = [
        (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, "one", "b"), (5, "One two THREE", "b"), (6, "one two three", None),
        (7, long, "a"), (8, long, "a"), (9, long + " end", "b"), (10, "x " * 400, "a"), (11, "x " * 300, "b"),
        (12, "  wide \u0085 spaces ", "é"), (13, "\U0001f600 smile 中文", "\U0001f600"), (14, "a\x00b c", "z")]
    base = prose(200, 9).split(" ")
    for k in range(30):
        words = list(base)
        for j in range(k % 7):
            words[(k * 31 + j * 17) % len(words)] = f"edit{k}_{j}"
        rows.append((100 + k, " ".join(words), f"s{k % 3}"))
    for k in range(20):
        rows.append((200 + k, prose(50 + k, 300 + k) + "\n" + shared + "\n" + prose(40, 500 + k), "a" if k % 2 else None))
    rows += [rows[20], rows[20], rows[6]]
    return rows


def table(spark, rows=None):
    """The corpus with further columns whose names clash with those that the operators use inside."""
    rows = corpus() if rows is None else rows
    return spark.createDataFrame([(d, t, None, s, len(t or ""), 0, None, "b", None, 7) for d, t, s in rows], SCHEMA)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


class Sets:
    """Union of ids, the smallest as the name."""

    def __init__(self, ids):
        self.parent = {i: i for i in ids}

    def find(self, x):
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.parent[b] = a


def near_duplicates(rows, width: int, percent: int) -> dict:
    sets = {}
    for d, t, _ in rows:
        w = words(lower(t))
        sets[d] = frozenset(tuple(w[i: i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()
    groups = Sets(sets)
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                groups.join(a, b)
    return {d: (len(s), groups.find(d), groups.find(d) == d) for d, s in sets.items()}


def without_repeats(rows, width: int) -> list:
    seen = Counter(tuple(w[i: i + width]) for _, t, _ in rows for w in [words(t)] for i in range(len(w) - width + 1))
    out = []
    for d, t, _ in rows:
        w = words(t)
        gone = {i + k for i in range(len(w) - width + 1) if seen[tuple(w[i: i + width])] > 1 for k in range(width)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)
