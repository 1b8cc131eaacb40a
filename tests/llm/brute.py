"""Plain versions of the operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingle_set(text, k):
    w = words(fold(text))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def jaccard_components(rows, k, percent):
    """Least doc_id of each row's component, by all pairs of rows."""
    sets = [shingle_set(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        ids[root(i)].append(d)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in ids.items()}
    return Counter((d, len(sets[i]), least[root(i)] if sets[i] else d) for i, (d, _) in enumerate(rows))


def decontaminate(rows, items, window=10):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(t))
    windows = defaultdict(set)
    for item, t in items:
        w = cut(t)
        if item is not None and w:
            n = min(len(w), window)
            for i in range(len(w) - n + 1):
                windows[tuple(w[i:i + n])].add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for d, t in rows:
        w = cut(t)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (g := tuple(w[i:i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[g]
        out.append((d, len(w), len(hit), sorted(found)))
    return out


def pii_base(text, luhn):
    text = text or ""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def rules(text, width=8):
    text = text or ""
    w = words(text)
    seen = Counter(tuple(w[i:i + width]) for i in range(len(w) - width + 1))
    repeated = {p for i in range(len(w) - width + 1) if seen[tuple(w[i:i + width])] > 1 for p in range(i, i + width)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated))


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def url(u, listed=RULES, default="allow"):
    if u is None or "://" not in u:
        return "", "", None, default
    rest = u.partition("://")[2]
    host = fold(re.match(r"[^/?#]*", rest)[0])
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    fits = [(len(h + p), h + p, v) for h, p, v in listed if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[1], max(fits)[2]) if fits else (host, path, None, default)


def trie(rows):
    """Nodes of rebuilt conversations, of (conv_id, turn, role, text) rows."""
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append(((t is not None, t or 0), hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest(), role, text))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        built[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    out = []
    for p, m in members.items():
        below = [q for q in members if q[:len(p)] == p]
        kids = [q for q in below if len(q) == len(p) + 1]
        ends = ",".join(map(str, sorted(c for c in m if built[c] == p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids),
                    sum(not any(len(r) > len(q) and r[:len(q)] == q for r in below) for q in below),
                    sum((len(members[q]) - 1) * len(words(q[-1][1])) for q in below if q), hashlib.sha256(ends.encode()).hexdigest()))
    return out


def token_alignment(rows, a, b, a_bytes, b_bytes):
    """Of each (doc_id, text) row the alignment of the ids that ``a`` and ``b`` give."""
    docs, count = [], Counter()
    for d, t in rows:
        ids = (a(t), b(t)) if t else ([], [])
        whole = f" {t}".encode()
        if not t or any(b"".join(map(f, x)) != whole for f, x in zip((a_bytes, b_bytes), ids)):
            docs.append((d, None))
            continue
        spans = []
        for f, x in zip((a_bytes, b_bytes), ids):
            at, own = 0, []
            for i in x:
                own.append((i, at, at := at + len(f(i))))
            spans.append(own)
        links = [(i, j) for i, s, e in spans[0] for j, u, v in spans[1] if s < v and u < e]
        both = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, lo = [], 0
        for hi in both:
            groups.append("|".join(",".join(str(i) for i, _, e in x if lo < e <= hi) for x in spans))
            lo = hi
        docs.append((d, (len(ids[0]), len(ids[1]), groups, links)))
        count.update(set(links))
    best = defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    return [(d, 0, 0, 0, 0, 0, 0, "") if x is None else
            (d, x[0], x[1], len(x[2]), len(x[3]), sum(count[p] == best[p[0]] for p in x[3]), sum(count[p] for p in x[3]), hashlib.sha256(";".join(x[2]).encode()).hexdigest())
            for d, x in docs]
