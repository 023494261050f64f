"""Plain versions of the operators, a row at a time."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import regex
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(s: str | bytes) -> str:
    return hashlib.sha256(s.encode() if isinstance(s, str) else s).hexdigest()


def quality(text):
    t = text or ""
    w = WORD.findall(t)
    grams = list(zip(w, w[1:], w[2:], strict=False))
    count, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def exact(rows):
    """{row: (keep id, size)} for rows (id, text), nulls last."""
    groups = {}
    for k, (i, t) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i or 0, k))
    out = {}
    for g in groups.values():
        best = min(g)
        for x in g:
            out[x[3]] = (rows[best[3]][0], len(g), x[3])
    return out


def simhash(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(t)
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(prints, distance=4):
    """{id: least id} for {id: fingerprint}."""
    up = {i: i for i in prints}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def secrets(text):
    t, out = text or "", []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A):
        if len(m[2]) >= 12:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
    return [f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(out)]


def linked_secrets(text):
    """All spans, weak parts compared with every other part of their scope."""
    t = text or ""
    base = [(int(s), k, int(e)) for k, s, e in (x.split(":") for x in secrets(t))]
    blank, scopes = re.compile(r"\n[\x20\t]*\n"), [0] * (len(t) + 1)
    for m in blank.finditer(t):
        for p in range(m.start(), len(t) + 1):
            scopes[p] += 1
    tokens = []
    for m in re.finditer(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}", t):
        w, n = m[0], len(m[0])
        entropy = -sum(c / n * math.log2(c / n) for c in Counter(w).values())
        if re.search("[0-9]", w) and re.search("[a-z]", w) and re.search("[A-Z]", w) and entropy >= 3.5:
            tokens.append((m.start(), "secret", m.end()))
    meets = lambda a, b: a[0] < b[2] and b[0] < a[2]
    weak = list(tokens)
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A):
        short = (m.start(), "secret", m.end())
        if len(m[2]) < 12 and not any(meets(short, x) for x in tokens):
            weak.append(short)
    weak += [(m.start(), "account", m.end()) for m in re.finditer(r"""\b(client|account|user|access)[_ -]?(id|name|key)?["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{4,}""", t, re.I | re.A)]
    weak = [w for w in weak if not any(meets(w, x) for x in base)]
    parts = [(m.start(), "endpoint", m.end()) for m in re.finditer(r"""\b[a-z][a-z0-9+.-]{1,20}://[^\s"'<>]+|\b(host|endpoint|server|url)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]+\.[A-Za-z]{2,}""", t, re.I | re.A)]
    parts += weak + [(s, "account" if k == "access" else "secret", e) for s, k, e in base]
    has = lambda w, kind: any(p[1] == kind and scopes[p[0]] == scopes[w[0]] and not meets(p, w) for p in parts)
    found = [w for w in weak if (has(w, "account") or has(w, "endpoint") if w[1] == "secret" else has(w, "secret") and has(w, "endpoint"))]
    order = ["assign", "access", "hex", "secret", "account"]
    return [f"{k}:{s}:{e}" for s, k, e in sorted(base + found, key=lambda x: (x[0], order.index(x[1]), x[2]))]


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def pii(text):
    t, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return [f"{('email', 'ip', 'card', 'phone')[k]}:{s}:{e}" for s, k, e in sorted(out)]


def pii_spans(rows):
    """[all spans] of rows (id, text), with those that bootstrapped contexts add."""
    kinds = ["email", "ip", "card", "phone"]
    lower = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x)
    number = lambda x: not regex.search(r"[\p{L}@]", x)
    name = lambda x: re.sub(r"[\x20()-]", "", x) if re.fullmatch(r"[+0-9\x20()-]+", x) else lower(x)
    base, found = [], []  # found: (row, start, end, pattern, instance, kind)
    for r, (_, t) in enumerate(rows):
        t = t or ""
        spans = sorted((int(s), kinds.index(k), int(e)) for k, s, e in (x.split(":") for x in pii(t)))
        base.append(spans)
        words = [(m.start(), m.end(), bool(re.search("[0-9@]", m[0]))) for m in WORD.finditer(t)]
        marked = ["@" if token else t[s:e] for s, e, token in words]
        before = {s: " ".join(marked[max(0, k - 2) : k]) for k, (s, _, _) in enumerate(words)}
        out, ends, runs = [], -1, []
        for s, k, e in spans:
            if s >= ends:
                inside = [w for w in words if w[2] and w[0] <= s < w[1]]
                out.append((s, t[s:e], before[inside[0][0]] if inside else "", kinds[k]))
            ends = max(ends, e)
        covered = bytearray(len(t))
        for s, _, e in spans:
            covered[s:e] = b"\1" * (e - s)
        for s, e, token in words:
            if token and not any(covered[s:e]):
                joins = runs and number(t[s:e]) and number(t[runs[-1][2] : runs[-1][1]]) and t[runs[-1][1] - 1] not in ".,;:!?" and re.fullmatch(r"\x20([-+./()]\x20)?", t[runs[-1][1] : s])
                if joins:
                    runs[-1] = (runs[-1][0], e, s)
                else:
                    runs.append((s, e, s))
        out += [(s, re.sub(r"""[.,;:!?)\]}"']+$""", "", t[s:e]), before[s], None) for s, e, _ in runs]
        for s, m, context, kind in out:
            pattern = re.sub("[0-9]+", "0", lower(context))
            pattern = sha(pattern) if len(pattern) > 128 else pattern
            if pattern and name(m):
                found.append((r, s, s + len(m), pattern, name(m), kind))
    edges = {(p, i) for _, _, _, p, i, _ in found}
    known = {}
    for _, _, _, _, i, k in found:
        if k and k > known.get(i, ""):
            known[i] = k

    def confident():
        count, of = Counter(p for p, _ in edges), Counter((p, known[i]) for p, i in edges if i in known)
        best = {}
        for (p, k), n in of.items():
            best[p] = max(best.get(p, (0, "")), (n, k))
        return {p: (k, n / count[p]) for p, (n, k) in best.items() if n >= 3 and n / count[p] >= 0.8}

    while True:
        patterns, doubt = confident(), {}
        for p, i in edges:
            if i not in known and p in patterns:
                k, c = patterns[p]
                doubt[i, k] = doubt.get((i, k), 1.0) * max(1 - c, 1e-9)
        new = {}
        for (i, k), d in doubt.items():
            if round(1 - d, 9) >= 0.8:
                new[i] = max(new.get(i, (0, "")), (round(1 - d, 9), k))
        if not new:
            break
        known |= {i: k for i, (_, k) in new.items()}
    patterns = confident()
    more = [[] for _ in rows]
    for r, s, e, p, i, kind in found:
        if kind is None and p in patterns and known.get(i) == patterns[p][0]:
            more[r].append((s, 4 + kinds.index(known[i]), e))
    return [",".join(f"{(kinds + ['like_' + k for k in kinds])[k]}:{s}:{e}" for s, k, e in sorted(a + b)) for a, b in zip(base, more, strict=True)]


def repeats(rows, window=50):
    """{row: (bytes, removed, spans, digest of what is left)} for rows (id, text); a null id is above all."""
    key = lambda i: float("inf") if i is None else i
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - window + 1):
            w = b[p : p + window]
            first[w] = min(first.get(w, key(i)), key(i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - window + 1):
            if first[b[p : p + window]] < key(i):
                gone[p : p + window] = b"\1" * window
        out.append((i, len(b), sum(gone), len(bytes(gone).replace(b"\0", b" ").split()), sha(bytes(c for c, x in zip(b, gone, strict=True) if not x))))
    return out


def mix(rows, domains, langs, percent, epochs, seed, sources=None):
    """[(id, epoch)] of rows (id, text, lang, source) by hierarchical water-filling in whole numbers."""
    none, sources = "(none)", sources or {}
    leafed = []
    for i, t, lang, source in rows:
        d = none if source is None else "core" if re.fullmatch("[^0-9]*[0-9]", source) else "tail"
        leafed.append((i, len(WORD.findall(t or "")), (d, lang or none, source or none)))
    tokens = Counter()
    for _, n, leaf in leafed:
        tokens[leaf] += n

    def share(budget, caps, weight):
        left, w = dict(caps), {k: weight(k) for k in caps}
        out = {k: 0 for k in caps if not w[k]}
        left = {k: c for k, c in left.items() if w[k]}
        while left:
            total = sum(w[k] for k in left)
            low = min(left, key=lambda k: (left[k] / w[k], k))
            if left[low] * total <= budget * w[low]:
                out[low] = left.pop(low)
                budget -= out[low]
            else:
                return out | {k: budget * w[k] // total for k in left}
        return out

    counts = lambda x: langs.get(x[1], 1) > 0 and sources.get(x[2], 1) > 0
    level = lambda n, under=(): {k: epochs * sum(v for x, v in tokens.items() if x[: n + 1] == (*under, k) and counts(x)) for k in {x[n] for x in tokens if x[:n] == under}}
    chosen = []
    for d, db in share(sum(tokens.values()) * percent // 100, level(0), lambda k: domains.get(k, 1)).items():
        for lang, lb in share(db, level(1, (d,)), lambda k: langs.get(k, 1)).items():
            for s, b in share(lb, level(2, (d, lang)), lambda k: sources.get(k, 1)).items():
                leaf = (d, lang, s)
                if not tokens[leaf]:
                    continue
                full, rest = divmod(b, tokens[leaf])
                own = [(hashlib.md5(f"{seed}:{full}:{'' if i is None else i}".encode()).hexdigest(), i, n) for i, n, x in leafed if x == leaf]
                for h, i, _ in own:
                    upto = sum(n for g, _, n in own if g <= h)
                    chosen += [(i, e) for e in range(full + (rest > 0 and upto <= rest))]
    return chosen
