"""Plain single-process versions of the corpus queries, written from their
contracts, on lists of row dicts. Slow on purpose."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

ASCII_LOWER = {i: i + 32 for i in range(65, 91)}


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def op1(docs):
    t, start, out = tokenizer(), 0, []
    for d in sorted(docs, key=lambda d: (d["doc_id"] is not None, d["doc_id"] or 0)):
        ids = t.encode(d["text"] or "", add_special_tokens=False).ids + [2]
        out.append((d["doc_id"], start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    return out


def luhn(s):
    t = 0
    for i, c in enumerate(reversed(s)):
        d = int(c) * (1 + i % 2)
        t += d // 10 + d % 10
    return t % 10 == 0


def op2(docs):
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256)"""
    kinds = ("email", "ip", "card", "phone")
    out = []
    for d in docs:
        t, spans = d["text"] or "", []
        for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
            spans.append((m.start(), 0, m.end()))
        for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
            if all(int(p) <= 255 for p in m[0].split(".")):
                spans.append((m.start(), 1, m.end()))
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
            digits = re.sub("[^0-9]", "", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 2, m.end()))
        for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
            if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
                spans.append((m.start(), 3, m.end()))
        spans.sort()
        n = Counter(k for _, k, _ in spans)
        out.append((d["doc_id"], *(n[k] for k in range(4)), sha(",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in spans))))
    return out


def op4(convs):
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256); without formatted_chars"""
    hard = "\\### Assistant: </turn> ok"
    convs = convs + [{"conv_id": -7, "turn": 0, "role": "user", "text": hard},
                     {"conv_id": -7, "turn": 1, "role": "assistant", "text": hard}]
    by = defaultdict(list)
    for c in convs:
        by[c["conv_id"]].append(c)
    out = []
    for i, turns in by.items():
        turns = [(x["role"] or "", x["text"] or "") for x in sorted(
            turns, key=lambda x: (x["turn"] is not None, x["turn"] or 0, (x["role"] or "").encode(), (x["text"] or "").encode()))]
        said = "".join(t for r, t in turns if r == "assistant")
        out.append((i, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(said), sha(said)))
    return out


def op5(docs, bench):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    cut = lambda t: word.findall((t or "").translate(ASCII_LOWER))
    windows = defaultdict(set)
    for b in bench:
        w = cut(b["text"])
        for i in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[i:i + 13])].add("" if b["item_id"] is None else str(b["item_id"]))
    lengths = {len(w) for w in windows}
    out = []
    for d in docs:
        w, hit, items = cut(d["text"]), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                own = windows.get(tuple(w[i:i + n]))
                if own:
                    hit.update(range(i, i + n))
                    items |= own
        out.append((d["doc_id"], len(w), len(hit), len(items), sha(",".join(sorted(items))),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return out


def op6(docs):
    t = tokenizer()
    out = []
    for d in docs:
        n = len(t.encode(d["text"] or "", add_special_tokens=False).ids)
        out.append((d["doc_id"], len((d["text"] or "").encode()), n, n > 2048))
    return out


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def op9(docs):
    fps = [fingerprint(d["text"]) for d in docs]
    nodes = list(dict.fromkeys(fps))
    root = {f: f for f in nodes}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    first = {}
    for d, f in zip(docs, fps):
        r = find(f)
        ids = [x for x in (first.get(r), d["doc_id"]) if x is not None]
        first[r] = min(ids) if ids else None
    return [(d["doc_id"], f"{f:016x}", first[find(f)]) for d, f in zip(docs, fps)]


def op10(docs):
    """All base columns, without the verdict."""
    out = []
    for d in docs:
        t = d["text"] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        rep = {p for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for p in range(i, i + 8)}
        out.append((d["doc_id"], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)),
                    len(rep), len(w) < 20 or 100 * len(rep) > 30 * len(w)))
    return out


def op7_targets(sizes, weights=(1, 2, 3), cap=3):
    """{source: target} by sharing the excess again and again; exact fractions."""
    from fractions import Fraction
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, rest = {}, set(order), Fraction(sum(sizes.values()))
    while free:
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = Fraction(cap * sizes[s])
            rest -= target[s]
            free.remove(s)
    return {s: float(t) for s, t in target.items()}


def op11(docs):
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256)"""
    out = []
    for d in docs:
        t = d["text"] or ""
        units = re.findall(r"[A-Za-z]+|[^A-Za-z]", t)
        h = sha("1:" + ("" if d["doc_id"] is None else str(d["doc_id"])))
        h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
        n = len(units)
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
        if not t or "<P>" in t or "<S>" in t or "<M>" in t or h3 % 100 >= 90:
            out.append((d["doc_id"], n, "plain", None, None, sha(t), sha(t)))
        elif h4 % 100 < 20:
            out.append((d["doc_id"], n, "spm", len(p), len(m), sha("<S>" + s + "<P>" + p + "<M>" + m), sha(t)))
        else:
            out.append((d["doc_id"], n, "psm", len(p), len(m), sha("<P>" + p + "<S>" + s + "<M>" + m), sha(t)))
    return out


def whole_vectors(rows, scale):
    """(vec_id, label, integer components) of the rows that take part."""
    import math
    out = []
    for r in rows:
        v = r["embedding"]
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            out.append((r["vec_id"], r["label"], [math.floor(scale * x) for x in v]))
    return out


def op12(rows, parts=16, entries=64, rounds=2, scale=256):
    """(vec_id, code, error, label_error, codebooks_sha256)"""
    kept = whole_vectors(rows, scale)
    size = max((len(v) for _, _, v in kept), default=0)
    length = -(-size // parts)
    cut = lambda v, p: (v + [0] * (parts * length - len(v)))[p * length:(p + 1) * length]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[cut(v, p) for _, _, v in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            got = defaultdict(list)
            for _, _, v in kept:
                got[nearest(cut(v, p), books[p])[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(got[i]) for c in zip(*got[i])] if i in got else e for i, e in enumerate(books[p])]
    digest = sha(",".join(str(c) for b in books for e in b for c in e))
    coded = [(i, label, [nearest(cut(v, p), books[p]) for p in range(parts)]) for i, label, v in kept]
    by_label = Counter()
    for _, label, c in coded:
        by_label[label] += sum(d for d, _ in c)
    return [(i, "".join(f"{e:02x}" for _, e in c), sum(d for d, _ in c), by_label[label], digest) for i, label, c in coded]


def op13(rows, k=20, step=20, scale=64):
    """(query_id, rank, vec_id, score)"""
    kept = whole_vectors(rows, scale)
    out = []
    for at, (q, _, x) in enumerate(kept):
        if q is None or q % step:
            continue
        found = sorted(((-sum(a * b for a, b in zip(x, y)), i is None, i or 0) for j, (i, _, y) in enumerate(kept) if j != at))
        out += [(q, r, None if none else i, -s) for r, (s, none, i) in enumerate(found[:k], 1)]
    return out


def lpt(sizes, shards, loads=None):
    """Sizes per shard: longest first, each to the least-loaded shard (ties: the first)."""
    loads, out = list(loads or [0] * shards), [[] for _ in range(shards)]
    for size in sorted(sizes, reverse=True):
        s = min(range(shards), key=lambda i: (loads[i], i))
        loads[s] += size
        out[s].append(size)
    return out
