"""Plain versions of operators, for small tables."""

from collections import defaultdict


def word_list(text):
    out, word = [], ""
    for c in text or "":
        if c in " \t\n\x0b\x0c\r":
            if word:
                out.append(word)
            word = ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    return out + [word] if word else out


def shingle_set(text, size=5):
    w = word_list(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def near_duplicates(docs):
    """docs: list of (doc_id, text) with distinct ids -> {doc_id: (n, component, kept)}."""
    sets = {i: shingle_set(t) for i, t in docs}
    holders = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            holders[x].add(i)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    seen = set()
    for group in holders.values():
        first = sorted(group)
        for k, a in enumerate(first):
            for b in first[k + 1 :]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    common = len(sets[a] & sets[b])
                    if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                        x, y = sorted((root(a), root(b)))
                        parent[y] = x
    return {i: (len(s), root(i), root(i) == i) for i, s in sets.items()}


EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal_spans(text):
    """Base spans of a text: (start, place, kind, end)."""
    import re

    out = []
    for place, (kind, pattern) in enumerate((("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE))):
        for m in re.finditer(pattern, text or ""):
            number = re.sub("[^0-9]", "", m.group())
            fine = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 14 <= len(number) <= 19 and luhn(number),
                "phone": lambda: 10 <= len(number) <= 15,
            }[kind]()
            if fine:
                out.append((m.start(), place, kind, m.end()))
    return sorted(out)
