"""Plain, slow versions of the query contracts, for comparison on small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import xxhash

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def op1(docs, min_docs=10, min_chars=1):
    """docs: [(doc_id, text)] -> {(doc_id, n_lines, n_dropped, sha)} as a Counter."""
    def key(line):
        return line.strip(" \t\n\r\x0b\x0c").translate(UP)
    seen = Counter(k for _, t in docs for k in {key(x) for x in (t or "").split("\n")} if len(k) >= min_chars)
    out = Counter()
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if seen[key(x)] < min_docs]
        out[(d, len(lines), len(lines) - len(kept), sha("\n".join(kept)))] += 1
    return out


def op2_base(text):
    words = WORD.findall(text or "")
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for x in lines:
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    tri = Counter(zip(words, words[1:], words[2:]))
    rep = {j for i in range(len(words) - 2) if tri[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return dict(n_words=len(words), word_chars=sum(map(len, words)), n_symbols=len(re.findall(r"[#*$%&|<>]", text or "")),
                n_dup_lines=dup, n_repeat_words=len(rep), base_failed=len(words) < 50 or 100 * len(rep) > 50 * len(words))


def op3(docs):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    out, start = [], 0
    for d, text in sorted(docs, key=lambda x: (x[0] is not None, x[0])):
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((d, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    return out


def op4(docs, items, width=10):
    terms = lambda t: TERM.findall((t or "").translate(UP))
    grams = defaultdict(set)
    for i, t in items:
        w = terms(t)
        n = min(width, len(w))
        for s in range(len(w) - n + 1 if w else 0):
            grams[tuple(w[s:s + n])].add("" if i is None else str(i))
    sizes = {len(g) for g in grams}
    out = Counter()
    for d, t in docs:
        w, hit, found = terms(t), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if (g := grams.get(tuple(w[s:s + n]))):
                    hit |= set(range(s, s + n))
                    found |= g
        out[(d, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit))] += 1
    return out


def op8(docs, limit=4096):
    from sentencepiece import SentencePieceProcessor
    s = SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))
    return Counter((d, len((t or "").encode()), n := len(s.encode(t or "")), n > limit) for d, t in docs)


def op9_fingerprint(text, n=3):
    words = WORD.findall((text or "").translate(UP))
    shingles = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] if len(words) >= n else [" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def op9(docs, bits=3):
    fps = [(d, op9_fingerprint(t)) for d, t in docs]
    distinct = sorted({f for _, f in fps})
    up = {f: f for f in distinct}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                up[find(a)] = find(b)
    least = {}
    for d, f in fps:
        if d is not None:
            least[find(f)] = min(d, least.get(find(f), d))
    return Counter((d, f"{f:016x}", least.get(find(f))) for d, f in fps)


def op10_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """{source: size} -> {source: target}, by dealing the excess again until none is left."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = share * sum(sizes.values()), set(order), {}
    while open_:
        unit = left / sum(w[s] for s in open_)
        over = {s for s in open_ if unit * w[s] > cap * sizes[s]}
        if not over:
            target.update({s: unit * w[s] for s in open_})
            break
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def op6(rows):
    """rows: [(conv_id, turn, role, text)] -> {conv_id: (n_turns, turns, loss_chars, loss)}"""
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is not None, t, r or "", x or ""))
    out = {}
    for c, turns in by.items():
        turns.sort(key=lambda x: x[:1] + ((x[1],) if x[0] else ()) + x[2:])
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for _, _, r, x in turns)), len(loss), sha(loss))
    return out


def op11(docs, longest=5, least=100, top=2000):
    """docs: [(lang, text)] -> [(lang, rank, phrase, a, l, r, n, score)]"""
    f, n = Counter(), Counter()
    for lang, t in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (t or "").translate(UP)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    cand = {p: a for p, a in f.items() if a >= least and len(p) > 2}
    out = defaultdict(list)
    for p, a in cand.items():
        lang, w = p[0], p[1:]
        inside = any(q[0] == lang and len(q) > len(p) and 100 * b >= 100 * a and any(q[1 + i:1 + i + len(w)] == w for i in range(len(q) - len(w)))
                     for q, b in cand.items())
        if not inside:
            score, cut = min((1000 * a * n[lang] // (f[p[:1 + c]] * f[(lang, *p[1 + c:])]), c) for c in range(1, len(w)))
            out[lang].append((-score, -a, " ".join(w).encode(), f[p[:1 + cut]], f[(lang, *p[1 + cut:])]))
    return [(lang, rank, p.decode(), -a, le, r, n[lang], -s)
            for lang, rows in out.items() for rank, (s, a, p, le, r) in enumerate(sorted(rows)[:top], 1)]


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def op12_shingles(text, words=5):
    """Distinct shingle hashes, as signed numbers."""
    w = [xxhash.xxh64_intdigest(x.encode(), 42) for x in WORD.findall((text or "").translate(UP))]

    def chained(hs):
        seed = 42
        for h in hs:
            seed = xxhash.xxh64_intdigest(h.to_bytes(8, "little"), seed)
        return _signed(seed)
    if len(w) < words:
        return {chained(w)} if w else set()
    return {chained(w[i:i + words]) for i in range(len(w) - words + 1)}


def op12_sketch(text, scale=8, least=64):
    below = -(1 << 63) + (1 << 64) // scale
    all_ = sorted(op12_shingles(text))
    few = [h for h in all_ if h < below]
    return few if len(few) >= least else all_[:least]


def op12_likeness(a, b, scale=8, least=64):
    below = -(1 << 63) + (1 << 64) // scale

    def bound(s):
        return (1 << 63) - 1 if len(s) < least else below - 1 if s[-1] < below else s[-1]
    x, y = ({h for h in s if h <= min(bound(a), bound(b))} for s in (a, b))
    return len(x & y) / len(x | y) if x | y else 1.0


def op12(docs):
    """docs: [(doc_id, text)], ids all different, None allowed once -> {doc_id: (n_chars, sha, fp, edited fp, near_edited, near_next)}"""
    order = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0)))
    out = {}
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        k = len(t) // 3
        edited = t[:len(t) - k] + nxt[:k]
        a, b, c = op12_sketch(t), op12_sketch(edited), op12_sketch(nxt)
        text = ["".join(f"{h & (1 << 64) - 1:016x}" for h in s) for s in (a, b)]
        out[d] = (len(t), sha(edited), *text, op12_likeness(a, b), op12_likeness(a, c))
    return out


SEARCH = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def op13(docs, items, k=10):
    """docs: [(doc_id, text)], items: [(item_id, text)] -> Counter of (item_id, rank, doc_id, score)"""
    import math
    terms = [(d, Counter(SEARCH.findall((t or "").translate(UP)))) for d, t in docs]
    sizes = [sum(c.values()) for _, c in terms]
    n_docs, n_terms = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in terms for t in c)
    out = Counter()
    for item, text in items:
        rows = []
        for (d, c), n in zip(terms, sizes):
            score = 0
            for t in SEARCH.findall((text or "").translate(UP)):
                if c[t]:
                    m = 100 - 75 + 75 * n * n_docs // n_terms
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                rows.append((-score, d is None, d or 0, d))
        rows.sort(key=lambda r: r[:3])
        out.update((item, rank, r[3], -r[0]) for rank, r in enumerate(rows[:k], 1))
    return out


def low_paths(pages, threshold, decay):
    """The style tree of a host, whole pages in memory: [(path, ...)] of branches of low importance all through.
    ``pages``: per page its nodes as (path, child paths, [(block, characters in links, characters)])."""
    from math import log
    merged = {}
    for nodes in pages:
        for path, kids, blocks in nodes:
            merged.setdefault(path, []).append((kids, blocks))
    value, best = {}, {}

    def importance(path):
        seen = merged[path]
        kids = {k for ks, _ in seen for k in ks}
        for k in kids:
            importance(k)
        texts = [bs for _, bs in seen if bs]
        content = None
        if texts:
            found = {}
            for bs in texts:
                whole = tuple(t for t, _, _ in bs)
                found[whole] = found.get(whole, 0) + 1
            fresh = 1 if len(texts) == 1 else 1 - sum(log(c) / log(len(texts)) for c in found.values()) / len(found)
            content = fresh * (1 - sum(x for bs in texts for _, x, _ in bs) / sum(x for bs in texts for _, _, x in bs))
        shapes = [ks for ks, _ in seen if ks]
        if shapes:
            counts = [shapes.count(s) for s in set(shapes)]
            own = 1 if len(shapes) == 1 else -sum(c / len(shapes) * log(c / len(shapes), len(shapes)) for c in counts)
            weigh = lambda k: max(sum(1 for ks, _ in merged[k] if ks), sum(1 for _, bs in merged[k] if bs))
            below = [(value[k], weigh(k)) for k in kids if value[k] is not None]
            mean = sum(v * w for v, w in below) / sum(w for _, w in below) if below else 0
            fade = decay ** len(counts)
            value[path] = max((1 - fade) * own + fade * mean, content or 0)
        else:
            value[path] = content
        of = [value[path], *[best[k] for k in kids]]
        best[path] = max((v for v in of if v is not None), default=None)

    for path in merged:
        if path not in value:
            importance(path)
    return {p for p, v in best.items() if v is not None and v < threshold}
