"""Plain versions of the corpus operators, for small inputs."""

import math
import re
from collections import Counter

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORDS.findall(text or "")]


def shingles(text, n=5):
    own = words(text)
    return {tuple(own[i:i + n]) for i in range(max(1, len(own) - n + 1))} if own else set()


def linked(a, b):
    return bool(a and b) and 100 * len(a & b) >= 75 * len(a | b)


def jaccard_components(rows):
    """Sorted (doc_id, number of shingles, smallest id of the component)."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if linked(sets[i], sets[j]) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (doc, _), x in zip(rows, label):
        if doc is not None:
            least[x] = min(least.get(x, doc), doc)
    return sorted(((d, len(s), least.get(x)) for (d, _), s, x in zip(rows, sets, label)), key=str)


def contained(docs, items):
    out = []
    for d, text in docs:
        held = shingles(text)
        for i, item in set(items):
            own = shingles(item)
            if own and 100 * len(own & held) >= 75 * len(own):
                out.append((d, i, len(own & held), len(own)))
    return sorted(out, key=str)


def luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                    "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def dedup_lines(rows, width=3):
    """Texts by (doc_id, text) after later windows are cut."""
    seen, cut, done = set(), {}, set()
    for d, t in sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is None, r[0] or 0)):
        lines = t.split("\n")
        full = [i for i, x in enumerate(lines) if WORDS.search(x)]
        for k in range(len(full) - width + 1):
            key = tuple(lines[i] for i in full[k:k + width])
            if key in seen:
                cut.setdefault((d, t), set()).update(range(full[k], full[k + width - 1] + 1))
            seen.add(key)
        done.add((d, t))
    return {(d, t): "\n".join(x for i, x in enumerate(t.split("\n")) if i not in cut.get((d, t), ())) for d, t in done}


def repeated_words(own, window=8):
    wins = [tuple(own[i:i + window]) for i in range(len(own) - window + 1)]
    n = Counter(wins)
    return len({i + k for i, w in enumerate(wins) if n[w] > 1 for k in range(window)})


def backoff_scores(rows, vocabulary):
    texts = [words(t) for _, t in rows]
    uni = Counter(w for t in texts for w in t)
    ordered = sorted(uni.values(), reverse=True)
    least = ordered[vocabulary] if len(ordered) > vocabulary else 0
    known = {w for w, c in uni.items() if c > least}
    pair = Counter((a, b) for t in texts for a, b in zip(t, t[1:]) if a in known and b in known)
    total, out = sum(map(len, texts)), []
    for (d, _), t in zip(rows, texts):
        own, own_pair, n, score = Counter(t), Counter(zip(t, t[1:])), max(total - len(t), 1), 0
        for i, w in enumerate(t):
            c = uni[w] - own[w] if w in known else 0
            alone = math.log(c / n) if c else math.log(0.4) - math.log(n)
            seen = pair.get((t[i - 1], w), 0) - own_pair[t[i - 1], w] if i else 0
            if i and seen > 0:
                score += round(1e6 * math.log(seen / (uni[t[i - 1]] - own[t[i - 1]])))
            else:
                score += round(1e6 * (alone + (math.log(0.4) if i else 0)))
        out.append((d, len(t), score / 1e6))
    return sorted(out, key=str)


def lloyd(points, centers, rounds):
    """Centres after ``rounds`` rounds, and (nearest, squared distance) of each point to them; whole numbers."""
    def near(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), i) for i, c in enumerate(centers))

    for _ in range(rounds):
        own = [near(x)[1] for x in points]
        for i in range(len(centers)):
            if members := [x for x, o in zip(points, own) if o == i]:
                centers[i] = [sum(column) // len(members) for column in zip(*members)]
    return centers, [near(x)[::-1] for x in points]


def whole(rows, scale, dimension):
    """(id, label, whole numbers) of the usable rows."""
    good = [r for r in rows if r[1] is not None and len(r[1]) == dimension and all(x is not None and math.isfinite(x) for x in r[1])]
    return [(r[0], r[2], [math.floor(scale * x) for x in r[1]]) for r in good]


def vector_codes(rows, parts, entries, rounds, scale, dimension):
    kept = whole(rows, scale, dimension)
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    width, books, codes, errors = dimension // parts, [], [""] * len(kept), [0] * len(kept)
    for p in range(parts):
        cut = slice(p * width, (p + 1) * width)
        book, near = lloyd([r[2][cut] for r in kept], [r[2][cut] for r in first], rounds)
        books.append(book)
        for k, (e, d) in enumerate(near):
            codes[k] += f"{e:02x}"
            errors[k] += d
    by_label = Counter()
    for r, e in zip(kept, errors):
        by_label[r[1]] += e
    return sorted(((r[0], c, e, by_label[r[1]]) for r, c, e in zip(kept, codes, errors)), key=str), books


def clusters(rows, count, rounds, scale, dimension, seed):
    import hashlib

    kept = whole(rows, scale, dimension)
    name = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[2])
    centers, near = lloyd([r[2] for r in kept], [r[2] for r in sorted(kept, key=name)[:count]], rounds)
    return sorted(((r[0], *n) for r, n in zip(kept, near)), key=str), centers


def dedup_substrings(rows, window=13):
    """(id, words, removed, text left) in the order of the rows; ids are numbers or None, which comes last."""
    rank = lambda d: math.inf if d is None else d
    own, first = [(rank(d), WORDS.findall(t or "")) for d, t in rows], {}
    for d, w in own:
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            first[key] = min(first.get(key, d), d)
    out = []
    for (doc, _), (d, w) in zip(rows, own):
        gone = {i + k for i in range(len(w) - window + 1) if first[tuple(w[i:i + window])] < d for k in range(window)}
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out
