"""Plain versions of what the operators compute, for comparison on small tables."""

import re
from itertools import combinations

import xxhash

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(nodes, links):
    """Smallest node reachable, for each node."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
    if not words:
        return 0
    runs = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(run.encode(), 42) for run in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_copies(rows):
    """{id: (fingerprint, component)} of (id, text) rows with distinct ids."""
    prints = {i: simhash(t) for i, t in rows}
    links = [(a, b) for a, b in combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 3]
    root = components(prints, links)
    return {i: (prints[i], root[i]) for i in prints}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))


def contamination(text, items, window=13):
    """(n_words, n_hit, items) of one text; items as (id, text)."""
    own, hit, found = words(text), set(), set()
    for name, item in items:
        w = words(item)
        size = min(window, len(w))
        runs = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if w else set()
        for k in range(len(own) - size + 1) if w else ():
            if tuple(own[k : k + size]) in runs:
                hit |= set(range(k, k + size))
                found.add(name)
    return len(own), len(hit), sorted(str(n) for n in found if n is not None)


def is_contaminated(text, items):
    n, hit, _ = contamination(text, items)
    return hit > 0 and 20 * hit >= n


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def personal(text):
    """Base spans (kind, start, end), by the patterns as they are written."""
    out = [("email", *m.span())
           for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    kinds = ("email", "ip", "card", "phone")
    return sorted(out, key=lambda s: (s[1], kinds.index(s[0])))
