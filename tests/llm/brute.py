"""Plain-Python versions of what the operators must return."""

import hashlib
import math
import re
import zlib
from collections import defaultdict

import xxhash


def fp64(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(fps):
    """{doc_id: smallest doc_id reachable} over links of at most 4 bits; fps: {doc_id: fp}."""
    parent = {f: f for f in fps.values()}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    every = sorted(parent)
    for i, a in enumerate(every):
        for b in every[:i]:
            if (a ^ b).bit_count() <= 4:
                parent[root(a)] = root(b)
    least = defaultdict(list)
    for d, f in fps.items():
        least[root(f)].append(d)
    return {d: min(least[root(f)]) for d, f in fps.items()}


KINDS = {
    "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
               re.ASCII | re.IGNORECASE, lambda m: len(m[2]) >= 6),
    "access": (r"AKIA[A-Z0-9]+", 0, lambda m: len(m[0]) >= 20),
    "hex": (r"[0-9a-f]+", 0, lambda m: len(m[0]) >= 24),
}


def secret_spans(text):
    spans = [(m.start(), k, kind, m.end()) for k, (kind, (pat, flags, ok)) in enumerate(KINDS.items())
             for m in re.finditer(pat, text, flags) if ok(m)]
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(spans))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


LICENCE_PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by",
                   "mit license": "mit"}


def licence_words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def licence_base(text):
    words = licence_words(text)
    at = [(i, label) for p, label in LICENCE_PHRASES.items() for i in range(len(words))
          if words[i:i + len(p.split())] == p.split()]
    return (len(words), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None),
            ",".join(sorted({label for _, label in at})))


def licence_labels(text, templates, min_share):
    """{label: best share} over every position of every template; templates: (label, notice, key phrases)."""
    words, best = licence_words(text), {}
    for label, notice, keys in templates:
        own = notice.split()
        for shift in range(-len(own), len(words)):
            there = [words[shift + i] if 0 <= shift + i < len(words) else None for i in range(len(own))]
            share = sum(a == b for a, b in zip(own, there)) / len(own)
            near = " " + " ".join(words[max(0, shift - 2):max(0, shift + len(own) + 2)]) + " "
            if share >= min_share and all(f" {k} " in near for k in keys):
                best[label] = max(share, best.get(label, 0))
    return best


def jaccard(a, b, n=5):
    def grams(t):
        w = t.lower().split()
        return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))}
    x, y = grams(a), grams(b)
    return len(x & y) / len(x | y)


UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def fim(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output)."""
    text = text or ""
    u = UNIT.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    pre, mid, suf = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return len(u), "plain", None, None, text
    if h4 % 100 < 80:
        return len(u), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(u), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def top_k(rows, k=5, every=50):
    """[(query's place, query_id, rank, vec_id, score)] of rows (vec_id, vector), repeats and odd vectors too."""
    code = {}
    for i, (_, v) in enumerate(rows):
        if v is not None and all(x is not None and math.isfinite(x) and math.isfinite(256 * x) for x in v):
            code[i] = [math.floor(256 * x) for x in v]
    out = []
    for i, c in code.items():
        if rows[i][0] is None or rows[i][0] % every:
            continue
        scores = [(-min(max(sum(x * y for x, y in zip(c, o)), -2 ** 63), 2 ** 63 - 1), rows[j][0] is None, rows[j][0] or 0)
                  for j, o in code.items() if j != i]
        out += [(rows[i][0], r + 1, None if none else v, -s) for r, (s, none, v) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def _hash(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def merkle_leaf(row):
    return _hash(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def merkle_tree(leaves):
    """All levels, the last with one node."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([_hash(*levels[-1][i:i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def _path(levels, i):
    """(run, place in the run) on each level that has several nodes."""
    for level in levels[:-1]:
        a = i // 16 * 16
        yield level[a:a + 16], i - a
        i //= 16


def merkle(rows):
    """[(doc_id, leaf, subroot, root, proof, folded, verified)] of rows (doc_id, source, lang, n_chars, text)."""
    order = sorted(rows, key=lambda r: (r[1] is not None, (r[1] or "").encode(), r[0] is not None, r[0] or 0, merkle_leaf(r)))
    groups = defaultdict(list)
    for r in order:
        groups[r[1]].append(r)
    trees = [merkle_tree([merkle_leaf(r) for r in g]) for g in groups.values()]
    top, out = merkle_tree([t[-1][0] for t in trees]), []
    root = top[-1][0]
    for k, (g, tree) in enumerate(zip(groups.values(), trees)):
        for i, r in enumerate(g):
            path = [*_path(tree, i), *_path(top, k)]
            proof = _hash(*(s for run, at in path for j, s in enumerate(run) if j != at))
            node = tree[0][i]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                node = merkle_leaf((*r[:4], re.sub("[A-Z]", lambda m: m[0].lower(), r[4])))
            for run, at in path:
                node = _hash(*run[:at], node, *run[at + 1:])
            out.append((r[0], tree[0][i], tree[-1][0], root, proof, node, node == root))
    return out


def url_verdicts(urls_known, order=4):
    """{url: (score, verdict)} of {url: allow, block or None}: models of both halves cross-fit the threshold."""
    def chars(u):
        rest = u.split("://", 1)[1] if "://" in u else u
        s = "\x02" * order + re.sub("[A-Z]", lambda m: m[0].lower(), rest) + "\x03"
        return [s[i:i + order + 1] for i in range(len(s) - order)]

    def model(kind, halves):
        nexts = defaultdict(lambda: defaultdict(int))
        for u, known in urls_known.items():
            if known == kind and half(u) in halves:
                for g in chars(u):
                    for k in range(order + 1):
                        nexts[k, g[order - k:order]][g[order]] += 1

        def log_p(g):
            p = 1 / 256
            for k in range(order + 1):
                seen = nexts.get((k, g[order - k:order]))
                if seen:
                    p = (seen.get(g[order], 0) + len(seen) * p) / (sum(seen.values()) + len(seen))
            return math.log(p)
        return log_p

    def half(u):
        return xxhash.xxh64_intdigest(u, 42) & 1

    def score(u, halves):
        allow, block = models[halves]
        return sum(allow(g) - block(g) for g in chars(u)) / len(chars(u))

    models = {h: (model("allow", h), model("block", h)) for h in ((0, 1), (0,), (1,))}
    at = {}
    for kind in ("allow", "block"):
        xs = [score(u, (1 - half(u),)) for u, known in urls_known.items() if known == kind]
        mean = sum(xs) / len(xs)
        at[kind] = mean, math.sqrt(sum((x - mean) ** 2 for x in xs) / len(xs)) + 1e-9
    (ma, sa), (mb, sb) = at["allow"], at["block"]
    bound = (ma * sb + mb * sa) / (sa + sb)
    return {u: (score(u, (0, 1)), known or ("allow" if score(u, (0, 1)) >= bound else "block"))
            for u, known in urls_known.items()}
