"""Plain versions of the operators over small tables, written from their contracts."""

import hashlib
import re
import zlib
from collections import Counter
from itertools import permutations

PUNCTUATED = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(rb"[^\x20\x09-\x0D]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def lower(data: bytes) -> bytes:
    return bytes(c + 32 if 65 <= c <= 90 else c for c in data)


def in_order(docs):
    return sorted(docs, key=lambda r: (r[0] is None, r[0] or 0, (r[1] or "").encode()))


def repeated_words(docs, length):
    seen, out = set(), []
    for i, text in in_order(docs):
        words = SPACED.findall((text or "").encode())
        gone = [False] * len(words)
        for j in range(len(words) - length + 1):
            window = tuple(words[j : j + length])
            if window in seen:
                gone[j : j + length] = [True] * length
            seen.add(window)
        out.append((i, len(words), sum(gone), sha(b" ".join(w for w, g in zip(words, gone) if not g))))
    return out


def repeated_bytes(docs, length):
    seen, out = set(), []
    for i, text in in_order(docs):
        raw = (text or "").encode()
        gone, upto = bytearray(len(raw)), 0
        for j in range(len(raw) - length + 1):
            window = raw[j : j + length]
            if window in seen:
                a = max(j, upto)
                gone[a : j + length] = b"\1" * (j + length - a)
                upto = j + length
            seen.add(window)
        spans = sum(1 for j in range(len(raw)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((i, len(raw), sum(gone), spans, sha(bytes(x for x, g in zip(raw, gone) if not g))))
    return out


def benchmark_hits(docs, items):
    windows = {}
    for i, text in items:
        words = PUNCTUATED.findall(lower((text or "").encode()))
        n = min(len(words), 10)
        for j in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[j : j + n]), set()).add(str(i))
    out = []
    for i, text in docs:
        words = PUNCTUATED.findall(lower((text or "").encode()))
        hit, met = [False] * len(words), set()
        for n in {len(w) for w in windows}:
            for j in range(len(words) - n + 1):
                if found := windows.get(tuple(words[j : j + n])):
                    met |= found
                    hit[j : j + n] = [True] * n
        out.append((i, len(words), sum(hit), len(met), sha(",".join(sorted(met)).encode()), any(hit)))
    return out


def licence_places(docs, phrases):
    out = []
    for i, text in docs:
        words = PUNCTUATED.findall(lower((text or "").encode()))
        places = []
        for phrase, label in phrases:
            own = [w.encode() for w in phrase.split()]
            places += [(j, label) for j in range(len(words) - len(own) + 1) if words[j : j + len(own)] == own]
        starts = [j for j, _ in places]
        out.append((i, len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places}))))
    return out


def shingles(text, n=5):
    words = SPACED.findall(lower((text or "").encode()))
    return {tuple(words[j : j + n]) for j in range(max(1, len(words) - n + 1))} if words else set()


def near_groups(docs, percent=75):
    sets = {i: shingles(t) for i, t in docs}
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    by = {}
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(i)
    for i, s in sets.items():
        both = {}
        for x in s:
            for j in by[x]:
                if j > i:
                    both[j] = both.get(j, 0) + 1
        for j, n in both.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((top(i), top(j)))
                up[b] = a
    return [(i, len(sets[i]), top(i), top(i) == i) for i in sets]


def _luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text):
    return re.sub("[^0-9]", "", text)


PERSONAL = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m: 12 <= len(_digits(m)) <= 19 and _luhn(_digits(m))),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 9 <= len(_digits(m)) <= 15),
)


def personal(docs):
    out = []
    for i, text in docs:
        spans = [(m.start(), k, f"{name}:{m.start()}:{m.end()}") for k, (name, pattern, good) in enumerate(PERSONAL) for m in pattern.finditer(text or "") if good(m[0])]
        out.append((i, *(sum(k == n for _, k, _ in spans) for n in range(4)), sha(",".join(s for _, _, s in sorted(spans)).encode())))
    return out


def top_scores(rows, k, every):
    import math

    good = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v in good:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in good if j != i)[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(scores, 1)]
    return out


RUN = re.compile("[A-Za-zÀ-ÿ]+")


def spelling(docs, least=5, ratio=5, every=199):
    """word, form, root, n, n_near, form_n."""
    counts = Counter()
    for i, text in docs:
        for run in RUN.findall(text or ""):
            run = lower_text(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % every == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= least}
    letters = sorted({c for w in words for c in w})
    rows = {}
    for w, n in words.items():
        cuts = {w[:j] + w[j + 1 :] for j in range(len(w))}
        puts = {w[:j] + c + w[j:] for j in range(len(w) + 1) for c in letters}
        swaps = {w[:j] + c + w[j + 1 :] for j in range(len(w)) for c in letters}
        near = sorted((-words[x], x) for x in (cuts | puts | swaps) - {w} if x in words)
        form = near[0] if near and -near[0][0] >= ratio * n else None
        rows[w] = (n, len(near), form)
    out = []
    for w, (n, n_near, form) in rows.items():
        root = w
        while rows[root][2]:
            root = rows[root][2][1]
        out.append((w, form[1] if form else None, root, n, n_near, -form[0] if form else None))
    return out


def lower_text(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def filter_audit(docs, labels):
    """docs: id, text, part; labels: id, quality, toxic. Every order is applied filter by filter, document by document."""
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    good, toxic = {i for i, q, _ in labels if q == 1} - {None}, {i for i, _, t in labels if t == 1} - {None}
    parts = {}
    for i, text, part in docs:
        text = text or ""
        words = SPACED.findall(text.encode())
        failed = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": i is not None and i > first[text],
        }
        parts.setdefault(part or "", []).append((i, {x for x, f in failed.items() if f}))
    out = []
    for part, rows in parts.items():
        found, shapley = [], Counter()
        for order in permutations("ABCDE"):
            alive = rows
            for step, x in enumerate(order, 1):
                gone = [(i, f) for i, f in alive if x in f]
                alive = [(i, f) for i, f in alive if x not in f]
                shapley[x] += len(gone)
                failing = sum(x in f for _, f in rows)
                only = sum(f == {x} for _, f in rows)
                found.append((part, "".join(order), step, len(alive), len(gone), failing - len(gone), only, sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), x))
        out += [(*r[:-1], shapley[r[-1]]) for r in found]
    return out
