"""Plain Python versions of the contracts, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict
from itertools import permutations
from math import floor, isfinite

UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII = str.maketrans(UP, LOW)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(ASCII))


def contaminated(docs, items, size=10):
    windows = {}
    for item, text in items:
        ws = words(text)
        if ws:
            for i in range(max(1, len(ws) - size + 1)):
                windows.setdefault(tuple(ws[i:i + size]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = {}
    for doc, text in docs:
        ws, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(ws) - n + 1):
                if (w := tuple(ws[i:i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[w]
        out[doc] = (len(ws), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}


def license_base(docs):
    out = {}
    for doc, text in docs:
        ws, places, labels = words(text), [], set()
        for label, phrase in PHRASES.items():
            p = phrase.split()
            at = [i for i in range(len(ws) - len(p) + 1) if ws[i:i + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        out[doc] = (len(ws), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))
    return out


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(s):
    total = 0
    for i, d in enumerate(reversed([int(c) for c in s if c in "0123456789"])):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(text):
    """Counts of email, ip, card, phone and the digest of their spans."""
    text, out, counts = text or "", [], []
    digits = lambda s: sum(c in "0123456789" for c in s)
    for kind, pattern, valid in (
        ("email", EMAIL, lambda s: True), ("ip", IP, lambda s: all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in s.split("."))),
        ("card", CARD, lambda s: 16 <= digits(s) <= 19 and _luhn(s)), ("phone", PHONE, lambda s: 8 <= digits(s) <= 15),
    ):
        found = [m.span() for m in pattern.finditer(text) if valid(m.group())]
        counts.append(len(found))
        out += [f"{kind}:{a}:{b}" for a, b in found]
    return (*counts, hashlib.sha256(",".join(out).encode()).hexdigest())


SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size=4):
    ws = SPACED.findall((text or "").translate(ASCII))
    return {tuple(ws[i:i + size]) for i in range(max(1, len(ws) - size + 1))} if ws else set()


def near_components(docs, size=4, percent=80):
    """doc_id: (set size, smallest linked id, kept), by comparing all documents that share a shingle."""
    sets = {doc: shingles(text, size) for doc, text in docs}
    parent = {doc: doc for doc in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for doc in sorted(sets):
        own, common = sets[doc], {}
        for s in own:
            for other in holders.get(s, ()):
                common[other] = common.get(other, 0) + 1
            holders.setdefault(s, []).append(doc)
        for other, n in common.items():
            if 100 * n >= percent * (len(own) + len(sets[other]) - n):
                a, b = root(doc), root(other)
                parent[max(a, b)] = min(a, b)
    return {doc: (len(own), root(doc), root(doc) == doc) for doc, own in sets.items()}


def repeats(docs, least=100):
    """doc_id: (bytes, removed bytes, removed runs, digest of the rest)."""
    seen, out = set(), {}
    for doc, text in sorted(docs):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - least + 1):
            piece = hashlib.blake2b(data[i:i + least], digest_size=12).digest()
            if piece in seen:
                gone[i:i + least] = b"\x01" * least
            else:
                seen.add(piece)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def jaccard(one, other):
    """Generalised Jaccard similarity of the counts of two-word shingles."""
    bags = []
    for text in (one, other):
        ws = SPACED.findall(text.translate(ASCII))
        bags.append(Counter(zip(ws, ws[1:])) if len(ws) > 1 else Counter(ws))
    a, b = bags
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def filter_audit(docs, labels):
    """(part, order, step): the counts, by applying each order to all documents one filter after the other."""
    good = {k for k, quality, _ in labels if quality == 1 and k is not None}
    toxic = {k for k, _, bad in labels if bad == 1 and k is not None}
    first = {}
    for doc, text, _ in docs:
        if doc is not None:
            first[text or ""] = min(doc, first.get(text or "", doc))
    parts = defaultdict(list)
    for doc, text, part in docs:
        t = text or ""
        ws = SPACED.findall(t)
        fails = {name for name, failed in (
            ("A", len(ws) < 50), ("B", 100 * len(set(ws)) < 65 * len(ws)), ("C", 100 * sum(c in UP for c in t) > 5 * len(t)),
            ("D", any(c in "#$%&*|" for c in t)), ("E", doc is not None and first[t] < doc)) if failed}
        parts[part or ""].append((fails, doc in good, doc in toxic))
    out = {}
    for part, rows in parts.items():
        shares = Counter()
        for order in permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone, kept = [r for r in left if f in r[0]], [r for r in left if f not in r[0]]
                failing = [r for r in rows if f in r[0]]
                shares[f] += len(gone)
                out[part, "".join(order), step] = [len(kept), len(gone), len(failing) - len(gone), sum(r[0] == {f} for r in rows),
                                                   sum(r[1] for r in gone), sum(r[2] for r in gone), f]
                left = kept
        for key, row in out.items():
            if key[0] == part:
                row[-1] = shares[row[-1]]
    return {k: tuple(v) for k, v in out.items()}


def whole(vector):
    """The vector as whole numbers, None where it takes no part."""
    if vector is None or any(x is None or not isfinite(x) for x in vector):
        return None
    return tuple(floor(1024 * x) for x in vector)


def top_k(rows, k=10, every=100):
    """Sorted (query_id, rank, vec_id, score), by comparing each query with each other row."""
    held = [(i, v) for i, x in rows if (v := whole(x)) is not None]
    out = []
    for n, (query, q) in enumerate(held):
        if query is None or query % every:
            continue
        found = sorted((-sum(a * b for a, b in zip(q, v)), i is None, i) for m, (i, v) in enumerate(held)
                       if m != n and len(v) == len(q))
        out += [(query, rank, i, -score) for rank, (score, _, i) in enumerate(found[:k], 1)]
    return sorted(out, key=lambda r: (r[0], r[1], r[2] is None, r[2], r[3]))


def vector_codes(rows, entries=256, rounds=4):
    """[(vec_id, code, error, label_error)], digest: Lloyd's rounds by comparing each part with each entry."""
    held = [(i, v, label) for i, x, label in rows if (v := whole(x)) is not None]
    if not held:
        return []
    width = len(held[0][1]) // 4
    cut = lambda v, p: v[p * width:(p + 1) * width]
    first = sorted(held, key=lambda r: (r[0] is None, r[0], r[1]))[:entries]
    books = [[list(cut(v, p)) for _, v, _ in first] for p in range(4)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, entry)), k) for k, entry in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            met = defaultdict(list)
            for _, v, _ in held:
                met[nearest(cut(v, p), book)[1]].append(cut(v, p))
            for k, own in met.items():
                book[k] = [sum(x) // len(own) for x in zip(*own)]
    out, totals = [], Counter()
    for i, v, label in held:
        found = [nearest(cut(v, p), book) for p, book in enumerate(books)]
        error = sum(d for d, _ in found)
        totals[label] += error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, label))
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return [(i, code, error, totals[label], digest) for i, code, error, label in out]
