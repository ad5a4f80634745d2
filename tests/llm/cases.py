"""Small tables with every odd case, and plain versions of what the operators compute."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, chunk long, node string, score double, _key long, _id string, label int"


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice("aeiou") + format(rng.randrange(vocabulary), "x").translate(str.maketrans("0123456789", "ghijklmnop")) for _ in range(words))


def odd_texts() -> list[tuple]:
    """(doc_id, text) with nulls, empty and blank texts, ties, repeated rows, copies, near copies and one long text."""
    base = prose(1, 80)
    near = base.split()
    near[40] = "changed"
    long = prose(2, 6_000, 5_000)
    return [
        (1, base), (2, base), (3, " ".join(near)), (4, prose(3, 60)), (4, prose(4, 60)), (5, None), (5, None), (6, ""), (7, " \t\n"), (8, "one"), (8, "one"), (9, "two words"),
        (None, base), (None, "Just NULL id"), (10, long), (11, prose(5, 30) + " " + " ".join(base.split()[10:60]) + "\n" + prose(6, 30)), (12, "x " * 100), (13, "ÄÖ é b.\x1c漢字 <|endoftext|> don't"),
        (14, base.upper()), (15, "one"),
    ]


def table(spark, rows: list[tuple] | None = None):
    """The rows with clashing extra columns."""
    rows = odd_texts() if rows is None else rows
    return spark.createDataFrame([(i, t, "en", f"s{k % 3}" if k % 4 else None, len(t or ""), k, "n", None, 1, "x", 0) for k, (i, t) in enumerate(rows)], SCHEMA)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def kept_words(texts: list, window: int) -> list[tuple[int, int, str]]:
    held = [words(t) for t in texts]
    seen = Counter(tuple(w[p : p + window]) for w in held for p in range(len(w) - window + 1))
    out = []
    for w in held:
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if seen[tuple(w[p : p + window])] > 1:
                gone[p : p + window] = [True] * window
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def shingles(text: str | None, size: int) -> frozenset:
    w = words(lower(text))
    return frozenset(tuple(w[p : p + size]) for p in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def components(rows: list[tuple], size: int, percent: int) -> list[tuple]:
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[find(k)].append(rows[k][0])
    low = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return [(i, len(s), low[find(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True))]


def ordered(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=repr)
