"""Brute-force versions of the corpus operators, in plain Python."""

import collections
import hashlib
import math
import random
import re
import zlib
from fractions import Fraction
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken

WORD = re.compile(rb"[^\x20\x09-\x0d]+")
SECRETS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}
PERSONAL = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def words(text):
    return WORD.findall((text or "").encode().lower())


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def shingles(text):
    w = words(text)
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def components(texts):
    """By id: the set's size and the smallest id reachable by links of 0.75 or more."""
    sets = {i: shingles(x) for i, x in texts.items()}
    lists = collections.defaultdict(list)
    for i, s in sets.items():
        for t in s:
            lists[t].append(i)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in {(a, b) for ids in lists.values() for a in ids for b in ids if a < b}:
        common = len(sets[a] & sets[b])
        if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def secrets(text):
    found = []
    for order, (kind, pattern) in enumerate(SECRETS.items()):
        for m in re.finditer(pattern, text or ""):
            value, least = {"assign": (m[m.lastindex or 0], 8), "access": (m[0], 16), "hex": (m[0], 32)}[kind]
            if len(value) >= least:
                found.append((m.start(), order, kind, m.end()))
    return [f"{kind}:{start}:{stop}" for start, _, kind, stop in sorted(found)]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(text):
    found = []
    for kind, pattern in PERSONAL.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(part) <= 255 for part in m[0].split(".")),
                "card": lambda: 13 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if good:
                found.append(f"{kind}:{m.start()}:{m.end()}")
    return found


def nearest(rows, every):
    good = [
        (i, np.array(v, float))
        for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    ids, points = np.array([i for i, _ in good]), np.array([v for _, v in good])
    found = {}
    for i, v in good:
        if i % every == 0:
            others = ids != i
            distance = np.sqrt(((points[others] - v) ** 2).sum(1))
            best = np.lexsort((ids[others], distance))[:10]
            found[i] = list(zip(ids[others][best].tolist(), distance[best].tolist()))
    return found


@lru_cache
def byte_coder():
    from tapeloom.llm.byte_bpe import load_ranks

    ranks = load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def byte_digests(text):
    ids = byte_coder().encode_ordinary(text or "")
    return len(ids), sha(" ".join(map(str, ids))), sha((text or "").encode())


def base_scores(texts):
    """By id: held out, tokens, known tokens, training tokens and the base score."""
    end = object()
    tokens = {i: [*words(x), end] for i, x in texts.items()}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    counts = collections.Counter(t for i, ts in tokens.items() if not out[i] for t in ts)
    total, distinct = sum(counts.values()), len(counts)
    return {
        i: (
            out[i],
            len(ts),
            sum(counts[t] > 0 for t in ts),
            total,
            sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in ts),
        )
        for i, ts in tokens.items()
    }


def mixed_texts(seed, count, pieces, most=14):
    """Random texts of the given pieces, with a null and a blank one among them."""
    draw = random.Random(seed)
    texts = {i: "".join(draw.choice(pieces) for _ in range(draw.randint(0, most))) for i in range(count)}
    texts[1], texts[2] = None, " \n\t"
    return texts


def model_scores(texts, weight=0.15):
    """log10 probabilities of the two-word mixture with counts rounded to their classes, from plain dicts."""
    bounds = sorted([1, 2, 3, *(m << e for e in range(1, 50) for m in (2, 3))])

    def stands(n):
        """What a count is rounded to: the geometric middle of its class."""
        if not n:
            return 0.0
        k = sum(b <= n for b in bounds) - 1
        return math.sqrt(bounds[k] * (bounds[k + 1] - 1))

    tokens = {i: words(x) + [b" "] for i, x in texts.items()}
    ones, twos = collections.Counter(), collections.Counter()
    for i, own in tokens.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            ones.update(own)
            twos.update(zip([None, *own], own))
    total, found = sum(ones.values()), {}
    for i, own in tokens.items():
        logs = 0.0
        for before, word in zip([None, *own], own):
            after = min(1, stands(twos[before, word]) / max(stands(ones[b" " if before is None else before]), 1))
            alone = min(1, (stands(ones[word]) + 1) / (total + len(ones) + 1))
            logs += math.log10(weight * after + (1 - weight) * alone)
        found[i] = logs
    return found


# -- manifest, decontamination, vector codes ------------------------------------------

ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII_LOWER = {b: b + 32 for b in range(0x41, 0x5B)}


def leaf(row):
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row]
    return sha("".join(parts))


def manifest(rows):
    """Rows (doc_id, source, lang, n_chars, text) to sorted result rows, all trees in memory."""

    def climb(nodes):
        """All levels of one tree."""
        levels = [nodes]
        while len(levels[-1]) > 1:
            last = levels[-1]
            levels.append([sha("".join(last[i : i + 16])) for i in range(0, len(last), 16)])
        return levels

    def path(levels, i):
        """The left and right siblings of leaf i, level by level."""
        for nodes in levels[:-1]:
            first = i // 16 * 16
            yield "".join(nodes[first:i]), "".join(nodes[i + 1 : first + 16])
            i //= 16

    sources = collections.defaultdict(list)
    for row in rows:
        sources[row[1]].append((row[0] is not None, row[0] or 0, leaf(row), row))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([entry[2] for entry in sorted(sources[s], key=lambda e: e[:3])]) for s in names}
    over = climb([trees[s][-1][0] for s in names])
    found = []
    for at, s in enumerate(names):
        for i, (_, _, own, row) in enumerate(sorted(sources[s], key=lambda e: e[:3])):
            steps = list(path(trees[s], i)) + list(path(over, at))
            x = own
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                x = leaf((*row[:4], None if row[4] is None else row[4].translate(ASCII_LOWER)))
            for left, right in steps:
                x = sha(left + x + right)
            proof = sha("".join(left + right for left, right in steps))
            found.append((row[0], own, trees[s][-1][0], over[-1][0], proof, x, x == over[-1][0]))
    return sorted(found, key=repr)


def contaminated(texts, items):
    """Rows (doc_id, text) against (item_id, text): n_words, hit words and items, by scanning everything."""
    split = lambda text: ITEM_WORD.findall((text or "").translate(ASCII_LOWER))
    windows = collections.defaultdict(set)
    for item, text in items:
        words = split(text)
        size = min(10, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows[tuple(words[i : i + size])].add(item)
    found = []
    for doc_id, text in texts:
        words = split(text)
        hit, seen = set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                own = tuple(words[i : i + size])
                if own in windows:
                    hit.update(range(i, i + size))
                    seen |= windows[own] - {None}
        ids = ",".join(sorted(map(str, seen)))
        found.append((doc_id, len(words), len(hit), len(seen), sha(ids), bool(hit)))
    return sorted(found, key=repr)


def vector_codes(rows):
    """Rows (vec_id, vector, label) to (vec_id, code, error, label_error, digest), in Python's integers."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[math.floor(Fraction(x) * 4096) for x in r[1]] for r in kept]
    if not whole:
        return []
    cut = len(whole[0]) // 8
    parts = [[v[p * cut : (p + 1) * cut] for v in whole] for p in range(8)]
    books = [[list(e) for e in part[:16]] for part in parts]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, entry)), i) for i, entry in enumerate(book))

    for _ in range(6):
        for part, book in zip(parts, books):
            chosen = [nearest(x, book)[1] for x in part]
            for entry in set(chosen):
                own = [x for x, c in zip(part, chosen) if c == entry]
                book[entry] = [sum(column) // len(own) for column in zip(*own)]
    codes, errors = [], []
    for i in range(len(kept)):
        best = [nearest(part[i], book) for part, book in zip(parts, books)]
        codes.append("".join(f"{c:02x}" for _, c in best))
        errors.append(sum(d for d, _ in best))
    totals = collections.Counter()
    for r, error in zip(kept, errors):
        totals[r[2]] += error
    digest = sha(",".join(str(x) for book in books for entry in book for x in entry))
    return sorted(
        [(r[0], code, error, totals[r[2]], digest) for r, code, error in zip(kept, codes, errors)], key=repr
    )
