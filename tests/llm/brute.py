"""Plain versions of the operators, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def shingle_set(text, width):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < width else frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))


def near(rows, width=5, percent=80):
    """(rk, doc_id, size, component, kept, head) of each row (doc_id, text, rk), sorted; a row is known by its rk, equal rows are one."""
    order = lambda r: (r[0] is None, r[0] or 0, r[2])
    nodes = sorted({(doc, text, rk) for doc, text, rk in rows}, key=order)
    sets = [shingle_set(t, width) for _, t, _ in nodes]
    up = list(range(len(nodes)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for b in range(len(nodes)):
        for a in range(b):
            if sets[a] and sets[b]:
                c = len(sets[a] & sets[b])
                if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
                    x, y = top(a), top(b)
                    up[max(x, y)] = min(x, y)
    found = {}
    for i, (doc, _, rk) in enumerate(nodes):
        first = nodes[top(i)]
        kept = rk == first[2] if first[0] is None else doc == first[0]
        found[rk] = (rk, doc, len(sets[i]), first[0], kept, first[2])
    return sorted((found[rk] for _, _, rk in rows), key=repr)


def repeats(rows, width):
    """(doc_id, n_words, n_removed, kept text) of each row."""
    split = [words(t) for _, t in rows]
    seen = Counter(tuple(w[i:i + width]) for w in split for i in range(len(w) - width + 1))
    out = []
    for (doc, _), w in zip(rows, split):
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i:i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


def line_dedup(rows, percent=80):
    """(doc_id, kept text, lines, removed) of each row (doc_id, text[, hash of the row]); equal rows are one document."""
    null_first = lambda doc: (doc is not None, doc or 0)
    lines = sorted({(null_first(doc), k, *rk, doc, t, line) for doc, t, *rk in rows if t is not None for k, line in enumerate(t.split("\n"))},
                   key=lambda x: x[:-3])
    gone, before = set(), []
    for *_, k, doc, t, line in [(x[1], *x[-3:]) for x in lines]:
        s = frozenset(words(line))
        if s and any(100 * len(o & s) >= percent * len(o | s) for o in before):
            gone.add((doc, t, k))
        before += [s] if s else []
    out = []
    for doc, t, *_ in rows:
        split = [] if t is None else t.split("\n")
        drop = [k for k in range(len(split)) if (doc, t, k) in gone]
        out.append((doc, None if t is None else "\n".join(x for k, x in enumerate(split) if k not in drop), len(split), len(drop)))
    return sorted(out, key=repr)


def secrets(text):
    """Base spans (start, kind number, end, kind)."""
    forms = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
             ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18), ("hex", re.compile("[0-9a-f]+"), 0, 16)]
    return sorted((m.start(), i, m.end(), kind) for i, (kind, form, group, least) in enumerate(forms)
                  for m in form.finditer(text or "") if len(m.group(group)) >= least)


def check_pieces(pieces, ids_of, window=4096):
    """Every id in exactly one piece, sequences gapless and padded at most once; pieces as rows of (doc_id, start, length, crc, tokens, sequence, offset)."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p[0]].append(p)
        by_sequence[p[5]].append(p)
    assert set(by_doc) == set(ids_of)
    for doc, ids in ids_of.items():
        at = 0
        for _, start, length, crc, tokens, _, _ in sorted(by_doc[doc], key=lambda p: p[1]):
            assert (start, tokens) == (at, len(ids)) and length > 0
            data = b"".join(i.to_bytes(4, "little") for i in ids[start:start + length])
            assert zlib.crc32(data) == crc
            at += length
        assert at == len(ids)
    sizes = []
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p[6]):
            assert p[6] == at
            at += p[2]
        assert at <= window
        sizes.append(at)
    assert sum(s < window for s in sizes) <= 1
    return sizes


def top_k(rows, is_query, k):
    """(query_id, rank, vec_id, score) of each query row against every other row of (vec_id, integer vector)."""
    out = []
    for i, (q, a) in enumerate(rows):
        if is_query(q):
            scores = sorted((-sum(x * y for x, y in zip(a, b)), c) for j, (c, b) in enumerate(rows) if j != i and len(a) == len(b))
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scores[:k])]
    return sorted(out)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
