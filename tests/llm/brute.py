"""The operators' results by the plainest means."""

import hashlib
import re
from collections import Counter, defaultdict

WS = " \t\n\x0b\x0c\r"


def lower(t):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), t)


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def small(d):
    return (d is not None, d)


def op1(docs):
    def key(line):
        return lower(line.strip(WS))

    holders = defaultdict(set)
    for d, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(d)
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 3 or max(holders[key(x)], key=small) == d]
        out.append((d, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def op2(docs):
    first = {}
    for d, t in sorted(docs, key=lambda r: small(r[0])):
        b = (t or "").encode()
        for i in range(len(b) - 99):
            first.setdefault(b[i : i + 100], (d, i))
    out = []
    for d, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 99):
            if first[b[i : i + 100]] != (d, i):
                gone[i : i + 100] = b"\1" * 100
        out.append((d, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def op6(docs, items):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))

    windows = defaultdict(set)
    for name, t in items:
        w = words(t)
        m = min(8, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            windows[tuple(w[i : i + m])].add(str(name))
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for m in {len(x) for x in windows}:
            for i in range(len(w) - m + 1):
                if x := windows.get(tuple(w[i : i + m])):
                    found |= x
                    hit.update(range(i, i + m))
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))), len(found) >= 2))
    return out


def op8(docs):
    out = []
    for d, t in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        n = Counter(zip(w, w[1:], w[2:]))
        covered = {i + k for i, x in enumerate(zip(w, w[1:], w[2:])) if n[x] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if x.strip(WS)]
        out.append((d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)))
    return out


def op9(docs):
    sets = []
    for d, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t or ""))
        n = min(5, len(w))
        sets.append(frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if n else frozenset())
    home = list(range(len(docs)))

    def root(x):
        while home[x] != x:
            x = home[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and docs[i][0] is not None and docs[j][0] is not None and 100 * len(a & b) >= 85 * len(a | b):
                home[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(d, len(s), least[root(i)] if d is not None else None) for i, ((d, _), s) in enumerate(zip(docs, sets))]


def luhn(d):
    return sum(x - 9 * (x > 9) for x in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(d)))) % 10 == 0


def op10(docs):
    digits = lambda m: re.sub("[^0-9]", "", m)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    ]
    out = []
    for d, t in docs:
        found = [[f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, t or "") if ok(m[0])] for k, p, ok in kinds]
        out.append((d, *map(len, found), sha(",".join(x for f in found for x in f))))
    return out
