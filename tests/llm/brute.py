"""Plain-Python versions of the operators, and the rows they are tested on."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

LONG = "lorem Ipsum dolor +49 30 1234567 " * 3000
PASSAGE = " ".join(f"w{i}" for i in range(70))
EDGES = [
    (900001, None),
    (900002, ""),
    (900003, " \t\n"),
    (900004, "1234 !!"),
    (900005, LONG),
    (900006, LONG),
    (900007, "one"),
    (900008, "one"),
    (900008, "one"),  # a row twice
    (900009, f"before {PASSAGE} after"),
    (900010, f"other {PASSAGE} end {PASSAGE} twice"),
    (900011, "a" * 1500),
    (900012, "Müller ñandú 日本語 ΣΑΣ ́ İ <|endoftext|> it's"),
    (None, f"no id {PASSAGE}"),
    (None, None),
]
#: Rows whose ids are null or shared while their texts differ: unique ones and copies of other rows' texts.
SHARED = [
    *((None, f"null id {i} " + " ".join(f"n{i}x{k}" for k in range(30))) for i in range(6)),
    *((910001, f"shared id {i} " + " ".join(f"s{i}x{k}" for k in range(30))) for i in range(6)),
    *((910002 + i, f"null id {i} " + " ".join(f"n{i}x{k}" for k in range(30))) for i in range(2)),
    (900001, "shared id 3 " + " ".join(f"s3x{k}" for k in range(30)) + "!"),
    (910009, "SHARED ID 4 " + " ".join(f"S4x{k}" for k in range(30))),
    (910009, "shared id 5 " + " ".join(f"S5x{k}" for k in range(30))),
    (None, "NULL id 5 " + " ".join(f"n5x{k}" for k in range(30))),
]
#: Columns whose names the operators use inside, or return.
CLASHES = (
    "keep_id n kept fp fingerprint component_id root best fold row_no recipe key key_a key_b shard ids parts first "
    "anchor posts spans start stop found score n_words runs h y band col vec query_id rank _id _sha _hot a b m unit"
).split()


def documents(spark, folder: str):
    """The documents of a test folder and the edge rows, with clashing columns."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    edges = spark.createDataFrame(EDGES, "doc_id long, text string").withColumns(
        {"lang": F.lit(None).cast("string"), "source": F.lit("edge"), "n_chars": F.length("text").cast("long")}
    )
    both = docs.unionByName(edges)
    return both.withColumns({c: F.lit(i) for i, c in enumerate(CLASHES)}).repartition(3)


def rows(df) -> list[tuple]:
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def order(doc_id) -> int:
    return -(1 << 63) if doc_id is None else doc_id


def sha(x: bytes | str) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def exact(data) -> Counter:
    """(doc_id, keep_id, group_size, sha256), and how many rows of a group stay."""
    groups = {}
    for i, t in data:
        groups.setdefault(t, []).append(i)
    return Counter((i, max(groups[t], key=order), len(groups[t]), sha(t)) for i, t in data)


def fingerprint(text: str, width: int = 3) -> int:
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()))
    shingles = [b" ".join(words[k : k + width]) for k in range(max(1, len(words) - width + 1))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near(data, budget: int = 2) -> Counter:
    """(doc_id, fingerprint, component_id)."""
    fps = [fingerprint(t) for _, t in data]
    root = list(range(len(data)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(data)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= budget:
                root[max(find(i), find(j))] = min(find(i), find(j))
    members = {}
    for i, (doc, _) in enumerate(data):
        members.setdefault(find(i), []).append(doc)
    least = {r: min((d for d in m if d is not None), default=None) for r, m in members.items()}
    return Counter((doc, f"{fps[i]:016x}", least[find(i)]) for i, (doc, _) in enumerate(data))


def exact_left(data) -> list[tuple]:
    """The rows that stay of the groups of equal texts."""
    last = {}
    for i, t in data:
        last[t] = max(last.get(t, i), i, key=order)
    return [(i, t) for t, i in last.items()]


def near_left(data, budget: int = 2) -> list[tuple]:
    """The rows that stay of the components of near copies."""
    fps = [fingerprint(t) for _, t in data]
    left, todo = [], set(range(len(data)))
    while todo:
        found, front = set(), {todo.pop()}
        while front:
            found |= front
            front = {j for j in todo if any((fps[i] ^ fps[j]).bit_count() <= budget for i in front)}
            todo -= front
        left.append(min((data[i] for i in found), key=lambda r: (r[0] is None, r[0] or 0, sha(r[1]))))
    return left


def passages(data, window: int = 50) -> Counter:
    """(doc_id, n_words, n_removed, sha256 of the kept words)."""
    cut = [(i, t.encode().split()) for i, t in data]
    least = {}
    for i, w in cut:
        for s in range(len(w) - window + 1):
            k = tuple(w[s : s + window])
            least[k] = min(least.get(k, order(i)), order(i))
    out = Counter()
    for i, w in cut:
        gone = np.zeros(len(w), bool)
        for s in range(len(w) - window + 1):
            if least[tuple(w[s : s + window])] < order(i):
                gone[s : s + window] = True
        out[i, len(w), int(gone.sum()), sha(b" ".join(x for x, g in zip(w, gone) if not g))] += 1
    return out


def strings(data, window: int = 400) -> Counter:
    """(doc_id, n_bytes, n_removed, n_spans, sha256 of the kept bytes)."""
    raw = [(i, t.encode()) for i, t in data]
    seen = Counter(b[s : s + window] for _, b in raw for s in range(len(b) - window + 1))
    out = Counter()
    for i, b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - window + 1):
            if seen[b[s : s + window]] > 1:
                gone[s : s + window] = True
        spans = int((gone[1:] > gone[:-1]).sum() + gone[0])
        kept = np.frombuffer(b, np.uint8)[~gone[:-1]].tobytes()
        out[i, len(b), int(gone.sum()), spans, sha(kept)] += 1
    return out


_BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def base_spans(text: str) -> list[tuple[str, int, int]]:
    def fits(kind: str, found: str) -> bool:
        digits = [int(c) for c in found if "0" <= c <= "9"]
        if kind == "ip":
            return all(int(x) <= 255 for x in found.split("."))
        if kind == "card":
            doubled = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
            return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    return [(k, *m.span()) for k, p in _BASE.items() for m in p.finditer(text) if fits(k, m[0])]
