"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def words(text: str | None, lower: bool = False) -> list[str]:
    text = text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate(UPPER) if lower else text)


def luhn(digits: str) -> bool:
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def _valid(kind: str, found: str) -> bool:
    digits = re.sub(r"[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    found = [
        (kind, m.start(), m.end())
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text or "")
        if _valid(kind, m.group())
    ]
    return sorted(found, key=lambda s: (s[1], list(PATTERNS).index(s[0])))


def exact(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(UPPER)].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), i == keep, digest) for i in ids]
    return out


def removed(rows, size: int = 13):
    least = {}
    for doc_id, text in rows:
        if doc_id is not None:
            w = words(text)
            for k in range(len(w) - size + 1):
                key = tuple(w[k : k + size])
                least[key] = min(doc_id, least.get(key, doc_id))
    out = []
    for doc_id, text in rows:
        w = words(text)
        gone = set()
        for k in range(len(w) - size + 1):
            if doc_id is not None and least.get(tuple(w[k : k + size]), doc_id) < doc_id:
                gone.update(range(k, k + size))
        out.append((doc_id, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def shingles(text: str | None, size: int = 5) -> set[tuple[str, ...]]:
    w = words(text, lower=True)
    n = min(size, len(w))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()


def components(rows, percent: int = 75):
    sets = {}
    for doc_id, text in rows:
        if doc_id is not None:
            sets[doc_id] = shingles(text)
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def leaks(rows, items, size: int = 5, least: float = 0.75):
    """(doc_id, item_id) with a window of the item's number of words that is similar enough."""

    def counts(w):
        n = min(size, len(w))
        return Counter(tuple(w[k : k + n]) for k in range(len(w) - n + 1))

    out = set()
    for item_id, item in items:
        own = words(item, lower=True)
        if not own:
            continue
        want = counts(own)
        for doc_id, text in rows:
            w = words(text, lower=True)
            if len(w) < min(size, len(own)):
                continue
            for k in range(max(1, len(w) - len(own) + 1)):
                have = counts(w[k : k + len(own)])
                low = sum((have & want).values())
                if low and low / (sum(have.values()) + sum(want.values()) - low) >= least:
                    out.add((doc_id, item_id))
                    break
    return out


def repeated(rows, size: int):
    """Per document, positions of words under a window that another document has too."""
    owners = defaultdict(set)
    for doc_id, text in rows:
        w = words(text)
        for k in range(len(w) - size + 1):
            owners[tuple(w[k : k + size])].add(doc_id)
    out = {}
    for doc_id, text in rows:
        w = words(text)
        found = set()
        for k in range(len(w) - size + 1):
            if len(owners[tuple(w[k : k + size])]) > 1:
                found.update(range(k, k + size))
        out[doc_id] = found
    return out


def dice_matches(rows, templates, least: float):
    def grams(text):
        w = re.sub(r"[\W_]+", " ", text.lower()).split()
        return {(a, b) for a, b in zip(w, w[1:], strict=False)}

    out = set()
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        units = list(enumerate(lines, 1)) + ([(0, " ".join(lines))] if len(lines) > 1 else [])
        for line, unit in units:
            own = grams(unit)
            scored = []
            for k, (name, notice) in enumerate(templates):
                other = grams(notice)
                score = 2 * len(own & other) / (len(own) + len(other)) if own else 0
                if score >= least:
                    scored.append((score, -k, name))
            if scored:
                score, _, name = max(scored)
                out.add((doc_id, line, name, round(score, 9)))
    return out


def edits(rows):
    """(doc_id, text, edited text, next text) in descending order of ids, null last."""
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for k, (doc_id, text) in enumerate(ordered):
        text, after = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        out.append((doc_id, text, text[: len(text) - half] + after[:half], after))
    return out


def terms(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def ranked(documents, items, k: int = 10):
    counted = [(d, Counter(terms(t))) for d, t in documents]
    counted = [(d, c) for d, c in counted if c]
    n, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = defaultdict(set)
    for item_id, text in items:
        asked[item_id].update(terms(text))
    out = []
    for item_id, wanted in asked.items():
        found = []
        for d, c in counted:
            m = 10 + (90 * sum(c.values()) * n) // length
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                for t in wanted & set(c)
            )
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item_id, r, x[3], -x[0]) for r, x in enumerate(sorted(found)[:k], 1)]
    return out


def collocations(rows, max_words: int = 3, least: int = 10, share: int = 50, best: int = 2000):
    counts, sizes = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            w = tuple(re.findall(r"[^\x20\x09]+", piece))
            sizes[lang] += len(w)
            for n in range(1, max_words + 1):
                counts.update((lang, w[i : i + n]) for i in range(len(w) - n + 1))
    candidates = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    absorbed = {
        (lang, w[i : i + n])
        for (lang, w), a in candidates.items()
        for n in range(2, len(w))
        for i in range(len(w) - n + 1)
        if 100 * a >= share * counts[lang, w[i : i + n]]
    }
    out = []
    for lang in sizes:
        scored = []
        for (at, w), a in candidates.items():
            if at == lang and (at, w) not in absorbed:
                cuts = [(counts[at, w[:k]], counts[at, w[k:]]) for k in range(1, len(w))]
                score, _, l, r = min((1_000_000 * a * a // (l * r), k, l, r) for k, (l, r) in enumerate(cuts))
                scored.append((-score, -a, " ".join(w).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, sizes[lang], -score))
    return out
