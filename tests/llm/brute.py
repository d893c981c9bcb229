"""Plain Python versions of the operators, and the small tables that they are held against."""

import hashlib
import re
import zlib
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: Nulls, empties, ties, repeated rows, a very long text and odd characters.
EDGES = [
    (1, "a b c"), (2, "A b C"), (3, None), (4, ""), (5, "   \n "), (6, "x " * 4000), (7, "one two three four five six seven"), (7, "one two three four five six seven"),
    (8, "é中😀 \t end "), (9, "▁▁ <s> </s> <|endoftext|> '' it's"), (None, "null id"), (10, "ONE two three four five six seven"), (11, "  two  spaces  "),
]
SCHEMA = "doc_id long, text string, fingerprint string, shard int, n int"


def table(spark, rows):
    """With extra columns whose names clash with those of results."""
    return spark.createDataFrame([(i, t, "f", 1, 2) for i, t in rows], SCHEMA)


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def crc(text) -> int:
    return zlib.crc32((text or "").encode())


def shingles(text) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def components(rows, percent=85):
    """doc_id -> (set size, least doc_id reachable)."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i in sorted(sets):
        shared = defaultdict(int)
        for s in sets[i]:
            for j in holders[s]:
                shared[j] += 1
            holders[s].append(i)
        for j, k in shared.items():
            if 100 * k >= percent * (len(sets[i]) + len(sets[j]) - k):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}


def edited(rows):
    """doc_id -> the edited text; doc_ids are distinct."""
    rows = sorted((i, t or "") for i, t in rows)
    out = {}
    for k, (i, t) in enumerate(rows):
        half = len(t) // 2
        out[i] = t[: len(t) - half] + rows[(k + 1) % len(rows)][1][:half]
    return out


def edit_distance_inside(item: str, text: str) -> int:
    """Edits of the best alignment of the whole item with some stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host) :])[0]


def verdict(url, rules):
    host, path = url_parts(url)
    fits = [(len(h) + len(p), len(h), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (max(fits)[3], max(fits)[2]) if fits else (None, "allow")
