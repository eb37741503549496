"""Plain Python versions of the contracts, for comparison."""

import hashlib
import re
from collections import Counter, defaultdict

SPACE = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        v = int(c) * (2 if i % 2 else 1)
        total += v // 10 + v % 10
    return total % 10 == 0


def pii(text):
    """n_email, n_ip, n_card, n_phone, base_sha256 by the patterns as they are given."""
    text = text or ""
    found = []
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+",
         lambda m: 16 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15),
    ]
    counts = []
    for kind, pattern, holds in kinds:
        spans = [m.span() for m in re.finditer(pattern, text) if holds(m.group())]
        counts.append(len(spans))
        found += [f"{kind}:{s}:{e}" for s, e in spans]
    return (*counts, hashlib.sha256(",".join(found).encode()).hexdigest())


def secrets(text):
    """n_assign, n_access, n_hex, base_sha256, and the base spans."""
    text = text or ""
    assign = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    spans = [(m.start(), 0, m.end()) for m in re.finditer(assign, text, re.ASCII) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    spans.sort()
    kinds = ("assign", "access", "hex")
    told = ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in spans)
    n = Counter(k for _, k, _ in spans)
    return n[0], n[1], n[2], hashlib.sha256(told.encode()).hexdigest(), told


def rules(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i:i + 3])].append(i)
    repeated = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated),
            n < 50 or 100 * len(repeated) > 50 * n)


def shingle_set(text, size=4):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def components(ids, links):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def near_duplicates(texts, size=4, least=80):
    """(n_shingles, component) by id."""
    sets = {i: shingle_set(t, size) for i, t in texts.items()}
    having = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            having[x].append(i)
    both = Counter()
    for at in having.values():
        for n, a in enumerate(at):
            for b in at[n + 1:]:
                both[a, b] += 1
    links = [(a, b) for (a, b), n in both.items() if 100 * n >= least * (len(sets[a]) + len(sets[b]) - n)]
    comp = components(sets, links)
    return {i: (len(sets[i]), comp[i]) for i in sets}
