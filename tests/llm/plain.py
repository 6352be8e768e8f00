"""Plain versions of the operators, and awkward inputs for all of them."""

import hashlib
import re
import zlib
from collections import defaultdict

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LONG = " ".join(f"word{i % 977} of {i % 13}" for i in range(30_000))

AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank at dawn"),
    (2, "The quick brown fox jumps over the lazy dog near the old river bank at dawn"),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, LONG),
    (7, "x"),
    (7, "x"),
    (8, "Grüße an müller.k@mail.example.de, Tel +49 (30) 1234-5678 😀 10.0.0.256 192.168.001.1"),
    (9, "a@b.c+d@e.f 4111 1111 1111 1111 und 4111-1111-1111-1112 999999999999999999999999"),
    (10, "IBAN DE89 3704 0044 0532 0130 00 and DE89370400440532013001, ssn 078-05-1120, 078-05-1120"),
    (None, "no key here"),
    (12, "\0odd\0 bytes  and   runs\n\n\nof space \r\n"),
    (13, "LINE one\nLINE one\nLINE one\n" * 30),
    (14, "1" * 50_000),
    (15, "a" * 50_000 + "@" + "b." * 20_000),
]


def table(spark, rows=None, extra=True):
    """``doc_id, text`` and columns whose names operators might use themselves."""
    rows = AWKWARD if rows is None else rows
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if extra:
        for name in ("key", "size", "fp", "score", "part", "length", "copy", "pii", "host", "n", "digest", "url"):
            df = df.selectExpr("*", f"'clash' as {name}")
    return df


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s, d: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s, d: all(int(x) <= 255 for x in s.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda s, d: 12 <= len(d) <= 19 and luhn(d)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s, d: 9 <= len(d) <= 15),
)


def base_spans(text):
    text, out = text or "", []
    for rank, (name, pattern, test) in enumerate(BASE):
        at = 0
        while (m := re.compile(pattern).search(text, at)) is not None:
            if test(m[0], re.sub("[^0-9]", "", m[0])):
                out.append((m.start(), rank, f"{name}:{m.start()}:{m.end()}"))
            at = m.end()
    return [s for _, _, s in sorted(out)]


def base_row(text):
    spans = base_spans(text)
    counts = [sum(s.startswith(name + ":") for s in spans) for name, _, _ in BASE]
    return [*counts, hashlib.sha256(",".join(spans).encode()).hexdigest()]


def quality_counts(text):
    text = text or ""
    words = WORDS.findall(text)
    n, seen, dup, where, marked = len(words), set(), 0, defaultdict(list), set()
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    for i in range(n - 2):
        where[tuple(words[i : i + 3])].append(i)
    for places in where.values():
        if len(places) > 1:
            for i in places:
                marked |= {i, i + 1, i + 2}
    failed = n < 50 or 100 * len(marked) > 50 * n
    return [n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(marked), failed]


def duplicate_share(words, k):
    """Share of the characters inside k-grams that occur twice or more."""
    where, marked = defaultdict(list), set()
    for i in range(len(words) - k + 1):
        where[tuple(words[i : i + k])].append(i)
    for places in where.values():
        if len(places) > 1:
            for i in places:
                marked |= set(range(i, i + k))
    total = sum(map(len, words))
    return sum(len(words[i]) for i in marked) / total if total else 0.0


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def simhash(text, size=3):
    import xxhash

    words = WORDS.findall(lower(text))
    grams = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, radius):
    """Index of the smallest member for each, over all pairs within the radius."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def contamination(text, items, window=10):
    """``items``: (id, text). The result's columns of one document."""
    words, hit, found = BENCH_WORDS.findall(lower(text)), set(), set()
    for item, body in items:
        parts = BENCH_WORDS.findall(lower(body))
        n = min(window, len(parts))
        grams = {tuple(parts[i : i + n]) for i in range(len(parts) - n + 1)} if n else set()
        for i in range(len(words) - n + 1) if n else ():
            if tuple(words[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                found |= {str(item)} if item is not None else set()
    return (len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
