"""Plain versions of the operators, on lists of texts."""

from __future__ import annotations

import math
import re
from collections import Counter

from touchline.llm import secrets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ASSIGN = re.compile(r"(?ai:(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?)([A-Za-z0-9+/_.=-]+)")


def words(text):
    return WORD.findall(text or "")


def shingle_set(text, size=5):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def components(rows, percent=85):
    """The least id that each row's links lead to; rows are (doc_id, text) with distinct ids."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                parent[top(i)] = top(j)
    tops = [top(i) for i in range(len(rows))]
    return {rows[i][0]: min(rows[j][0] for j in range(len(rows)) if tops[j] == tops[i]) for i in range(len(rows))}


def without_repeats(texts, size=35):
    """Per text, which of its words stay."""
    split = [words(t) for t in texts]
    seen = Counter(tuple(w[i : i + size]) for w in split for i in range(len(w) - size + 1))
    result = []
    for w in split:
        gone = set()
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                gone.update(range(i, i + size))
        result.append([x for i, x in enumerate(w) if i not in gone])
    return result


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def random_looking(hit):
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else None for c in hit]
    changes = sum(None not in pair and pair[0] != pair[1] for pair in zip(kinds, kinds[1:]))
    bits = -sum(n / len(hit) * math.log2(n / len(hit)) for n in Counter(hit).values())
    return 4 * changes >= len(hit) and 12 * hit.count("/") <= len(hit) and bits >= 3.5


def all_spans(text, scope=400):
    """Strong spans and the weak ones that another part completes, every pair tried."""
    text = text or ""
    strong = base_spans(text) + [(m.start(), 6, m.end()) for m in re.finditer(secrets.LOGIN, text)]
    weak = []
    for m in re.finditer(rf"(?P<e>{secrets.ENDPOINT})[^\x00-\x20\"'<>]*|(?P<a>{secrets.ACCOUNT})|(?P<o>{secrets.OPAQUE})", text):
        if m["e"]:
            weak.append((m.start(), 5, m.end("e")))
        elif m["a"]:
            weak.append((m.start(), 3, m.end()))
        elif random_looking(m["o"]):
            weak.append((m.start(), 4, m.end()))

    def clear(x):
        return not any(x[0] < s[2] and s[0] < x[2] and (s[1], x[1]) != (6, 5) for s in strong)

    weak = [x for x in weak if clear(x)]
    needs = {3: {0, 2, 4, 6}, 4: {1, 3, 5}, 5: {0, 2, 4, 6}}
    linked = [x for x in weak if any(y[1] in needs[x[1]] and abs(x[0] - y[0]) <= scope for y in strong + weak)]
    return sorted(strong + linked)


def measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text, w = text or "", words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    threes = list(zip(w, w[1:], w[2:]))
    seen = Counter(threes)
    covered = {j for i, x in enumerate(threes) if seen[x] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)
