"""Plain Python versions of the operators' contracts, for small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text, lower=False):
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)


def near_duplicates(docs, k=5, num=85, den=100):
    """docs: (doc_id, text) with distinct ids."""
    sets = {}
    for i, text in docs:
        w = words(text, True)
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index, shared = defaultdict(list), Counter()
    for i, s in sets.items():
        for g in s:
            for j in index[g]:
                shared[j, i] += 1
            index[g].append(i)
    for (a, b), n in shared.items():
        if den * n >= num * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i), root(i) == i) for i, s in sets.items()}


def repetition(text):
    w, text = words(text), text or ""
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if windows[tuple(w[i:i + 8])] > 1:
            covered.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


def cut_repeats(docs, span=50):
    """docs: (doc_id, text) with distinct ids; (n_words, n_removed, sha) by id."""
    first, out = {}, {}
    split = {i: words(t) for i, t in docs}
    for i in sorted(split):
        w = split[i]
        for j in range(len(w) - span + 1):
            first.setdefault(tuple(w[j:j + span]), i)
    for i, w in split.items():
        gone = np.zeros(len(w), dtype=bool)
        for j in range(len(w) - span + 1):
            if first[tuple(w[j:j + span])] < i:
                gone[j:j + span] = True
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest())
    return out


def leaks(docs, items, span=12):
    """{(doc_id, item_id): longest overlap}; equal items are named by the smallest id.

    Two words may differ in 12, one in a whole item of 8 to 11 words, none in one of 5 to 7; shorter items must be the whole text.
    """
    named = {}
    for i, text in sorted(x for x in items if x[0] is not None and x[1] is not None):
        named.setdefault(tuple(words(text, True)), i)
    out = {}
    for d, text in docs:
        doc = words(text, True)
        for item, i in named.items():
            need = min(span, len(item))
            if not need or need < 5 and item != tuple(doc):
                continue
            differ = 2 if need == span else int(need >= 8)
            for diagonal in range(-len(item) + need, len(doc) - need + 1):
                low, high = max(0, -diagonal), min(len(item), len(doc) - diagonal)
                equal = [item[p] == doc[p + diagonal] for p in range(low, high)]
                good = [p for p in range(len(equal) - need + 1) if sum(equal[p:p + need]) >= need - differ]
                runs = []
                for p in good:
                    if runs and p <= runs[-1][1]:
                        runs[-1][1] = p + need
                    else:
                        runs.append([p, p + need])
                for a, b in runs:
                    out[d, i] = max(out.get((d, i), (0, 0)), (b - a, sum(equal[a:b])))
    return out


def token_digests(docs, tokenizer, end=1):
    """[(ids, crc)] in the order of docs."""
    out = []
    for _, text in docs:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [end], dtype="<u4")
        out.append((ids, zlib.crc32(ids.tobytes())))
    return out


def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host):])[0]


def url_rule(url, rules):
    host, path = url_parts(url)
    fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)
