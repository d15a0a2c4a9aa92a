"""Plain, slow versions of what the operators compute."""

import collections
import hashlib
import re

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.001"
EXTRA = "doc_id long, text string, lang string, source string, n_chars long, pii string, toxicity string, contamination int, gone int, score int, rank int"


def edge_docs(spark):
    """Nulls, empty and very long texts, repeated rows, ties, clashing columns."""
    long = " ".join(f"w{i % 997}" for i in range(60_000)) + " " + "9" * 30_000 + " " + "x" * 30_000 + "@"
    rows = [(1, None), (2, ""), (3, long), (4, "only three words"), (5, "only three words"), (5, "only three words"),
            (None, "a row without an id and with words"), (6, "   \n\t "), (7, "é" * 50 + " tail"), (8, long + " end")]
    return spark.createDataFrame([(i, t, "en", None, 1, "p", "t", 1, 2, 3, 4) for i, t in rows], EXTRA)


def edge_texts(spark):
    return [(r.doc_id, r.text) for r in edge_docs(spark).collect()]


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def contamination(docs, items, window=10):
    windows = collections.defaultdict(set)
    for i, t in items:
        w = bench_words(t)
        k = min(window, len(w))
        for a in range(len(w) - k + 1) if k else ():
            windows[tuple(w[a:a + k])].add("null" if i is None else str(i))
    sizes = {len(k) for k in windows}
    for i, t in docs:
        w, hit, found = bench_words(t), set(), set()
        for k in sizes:
            for a in range(len(w) - k + 1):
                if own := windows.get(tuple(w[a:a + k])):
                    hit.update(range(a, a + k))
                    found |= own
        yield (i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))


def components(ids, edges):
    up = {i: i for i in ids}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {i: top(i) for i in ids}


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def similar(docs):
    """{doc_id: component} over (id, text) rows by comparing all sets."""
    sets = [(i, shingles(t)) for i, t in docs if i is not None]
    edges = []
    for x, (i, a) in enumerate(sets):
        for j, b in sets[x + 1:]:
            if a and b and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)):
                n = len(a & b)
                if 100 * n >= 80 * (len(a) + len(b) - n):
                    edges.append((i, j))
    return components({i for i, _ in sets}, edges)


KINDS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(len(x.lstrip("0")) < 4 and int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15),
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for rank, (kind, pattern, good) in enumerate(KINDS):
        out += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text or "") if good(m[0])]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(out)]
