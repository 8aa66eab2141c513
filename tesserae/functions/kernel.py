"""String scorers over whole batches: a bit-parallel longest common subsequence on arrays of words.

For each pair, bit j of a 64-bit word stands for character j of the second string; a step takes one character of the first
strings of all pairs at once. Longer strings use Python's unbounded integers by the same recurrence.
"""

from __future__ import annotations

import numpy as np


def _lcs_one(a: str, b: str) -> int:
    places: dict[str, int] = {}
    for j, c in enumerate(b):
        places[c] = places.get(c, 0) | 1 << j
    full = (1 << len(b)) - 1
    s = full
    for c in a:
        u = s & places.get(c, 0)
        s = ((s + u) | (s - u)) & full
    return len(b) - s.bit_count()


def lcs_lengths(left: list[str], right: list[str]) -> np.ndarray:
    out = np.zeros(len(left), dtype=np.int64)
    short = [i for i, (a, b) in enumerate(zip(left, right)) if a and b and len(b) <= 63 and len(a) <= 4096]
    for i, (a, b) in enumerate(zip(left, right)):
        if a and b and (len(b) > 63 or len(a) > 4096):
            out[i] = _lcs_one(a, b)
    for lo in range(0, len(short), 20_000):
        part = sorted(short[lo : lo + 20_000], key=lambda i: -len(left[i]))
        alphabet = {c: k for k, c in enumerate(sorted(set().union(*(right[i] for i in part))))}
        lengths = np.array([len(right[i]) for i in part])
        masks = np.zeros((len(part), len(alphabet) + 1), dtype=np.uint64)  # the last column: in no second string
        rows = np.repeat(np.arange(len(part)), lengths)
        codes = np.array([alphabet[c] for i in part for c in right[i]])
        places = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        np.bitwise_or.at(masks, (rows, codes), np.uint64(1) << places.astype(np.uint64))
        firsts = np.array([len(left[i]) for i in part])
        begins = np.concatenate(([0], np.cumsum(firsts)))[:-1]
        flat = np.array([alphabet.get(c, len(alphabet)) for i in part for c in left[i]])
        full = (np.uint64(1) << lengths.astype(np.uint64)) - np.uint64(1)
        s = full.copy()
        for t in range(int(firsts[0]) if len(firsts) else 0):
            n = int(np.searchsorted(-firsts, -t, side="left"))
            u = s[:n] & masks[np.arange(n), flat[begins[:n] + t]]
            s[:n] = ((s[:n] + u) | (s[:n] - u)) & full[:n]
        out[part] = lengths - np.bitwise_count(s).astype(np.int64)
    return out


def ratios(left: list[str], right: list[str]) -> np.ndarray:
    """2 * LCS / (sum of lengths); 1 if both are empty, 0 if one is."""
    total = np.array([len(a) + len(b) for a, b in zip(left, right)], dtype=np.float64)
    both = np.array([bool(a) == bool(b) for a, b in zip(left, right)])
    return np.where(total > 0, 2.0 * lcs_lengths(left, right) / np.maximum(total, 1), both.astype(float))


def sorted_tokens(texts: list[str]) -> list[str]:
    return [" ".join(sorted(t.split())) for t in texts]


def token_set(left: list[str], right: list[str]) -> np.ndarray:
    """The best ratio among the shared words, and the shared words with the rest of either side."""
    rest_a, rest_b, common = [], [], []
    for a, b in zip(left, right):
        x, y = set(a.split()), set(b.split())
        common.append(len(" ".join(sorted(x & y))) if x & y else 0)
        rest_a.append(" ".join(sorted(x - y)))
        rest_b.append(" ".join(sorted(y - x)))
    lcs = lcs_lengths(rest_a, rest_b)
    out = np.zeros(len(left))
    for i, (a, b, c, shared) in enumerate(zip(rest_a, rest_b, common, lcs.tolist())):
        if not left[i].split() or not right[i].split():
            continue
        if c and (not a or not b):
            out[i] = 1.0
            continue
        gap = 1 if c else 0
        la, lb = c + gap + len(a), c + gap + len(b)
        out[i] = 1 - (len(a) + len(b) - 2 * shared) / max(1, la + lb)
        if c:
            out[i] = max(out[i], 2 * c / (c + la), 2 * c / (c + lb))
    return out


def lcs_at(first: list[str], second: list[str], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The lengths for the pairs first[i], second[j] of two lists of strings: each string is read once, whatever its number of pairs."""
    out = np.zeros(len(i), dtype=np.int64)
    sizes_a, sizes_b = (np.array([len(x) for x in texts], dtype=np.int64) for texts in (first, second))
    la, lb = sizes_a[i], sizes_b[j]
    some = (la > 0) & (lb > 0)
    plain, turned = some & (lb <= 63), some & (lb > 63) & (la <= 63)
    for where, a, b, x, y in ((plain, first, second, i, j), (turned, second, first, j, i)):
        at = np.flatnonzero(where)
        if len(at):
            out[at] = _lcs_short(a, b, x[at], y[at])
    known: dict[tuple[int, int], int] = {}
    for at in np.flatnonzero(some & ~plain & ~turned).tolist():
        pair = int(i[at]), int(j[at])
        if pair not in known:
            known[pair] = _lcs_one(first[pair[0]], second[pair[1]])
        out[at] = known[pair]
    return out


def _used(texts: list[str], at: np.ndarray) -> tuple[list[str], np.ndarray]:
    held = np.zeros(len(texts), dtype=bool)
    held[at] = True
    return [texts[k] for k in np.flatnonzero(held).tolist()], (np.cumsum(held) - 1).take(at)


def _lcs_short(first: list[str], second: list[str], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The same for second strings of 1 to 63 characters."""
    (first, i), (second, j) = _used(first, i), _used(second, j)
    alphabet = {c: k for k, c in enumerate(sorted(set().union(*second)))}
    width, none = len(alphabet) + 1, len(alphabet)  # the last column: in no second string
    lengths = np.array([len(x) for x in second])
    masks = np.zeros(len(second) * width, dtype=np.uint64)
    rows = np.repeat(np.arange(len(second)), lengths)
    places = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    np.bitwise_or.at(masks, rows * width + np.array([alphabet[c] for x in second for c in x]), np.uint64(1) << places.astype(np.uint64))
    firsts = np.array([len(x) for x in first])
    flat = np.array([alphabet.get(c, none) for x in first for c in x], dtype=np.int64)
    begins = np.cumsum(firsts) - firsts
    order = np.argsort(-firsts[i].astype(np.int32), kind="stable")
    out = np.zeros(len(i), dtype=np.int64)
    for lo in range(0, len(order), 16_384):
        part = order[lo : lo + 16_384]
        size, at, base = firsts[i[part]], begins[i[part]], j[part] * width
        full = (np.uint64(1) << lengths[j[part]].astype(np.uint64)) - np.uint64(1)
        s = full.copy()
        ends = np.searchsorted(-size, -np.arange(int(size[0])), side="left").tolist()  # so many are longer than t
        for t, n in enumerate(ends):
            mine = s[:n]
            place = flat.take(at[:n] + t)
            place += base[:n]
            u = masks.take(place)
            u &= mine
            rest = mine - u
            mine += u  # what is carried beyond a string's end touches no bit below
            mine |= rest
        out[part] = lengths[j[part]] - np.bitwise_count(s & full).astype(np.int64)
    return out


def ratios_at(texts: list[str], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """`ratios` of the pairs texts[i], texts[j]."""
    sizes = np.array([len(x) for x in texts], dtype=np.int64)
    la, lb = sizes[i], sizes[j]
    total = (la + lb).astype(np.float64)
    return np.where(total > 0, 2.0 * lcs_at(texts, texts, i, j) / np.maximum(total, 1), ((la == 0) == (lb == 0)).astype(float))


def token_set_at(texts: list[str], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """`token_set` of the pairs texts[i], texts[j]: strings with the same words left over are compared once."""
    import pyarrow as pa

    words = [sorted(set(t.split())) for t in texts]
    ours, theirs = set().union(*(words[k] for k in np.unique(i).tolist())), set().union(*(words[k] for k in np.unique(j).tolist()))
    names = {w: k for k, w in enumerate(sorted(ours & theirs))}  # words of one side alone are never shared
    kept = [[w for w in x if w in names] for x in words]
    most = max((len(x) for x in kept), default=0)
    if most > 31 or len(texts) >= 1 << 31:
        return token_set([texts[k] for k in i.tolist()], [texts[k] for k in j.tolist()])
    table = np.full((most, len(texts)), -1, dtype=np.int32)
    for k, x in enumerate(kept):
        for at, w in enumerate(x):
            table[at, k] = names[w]
    mask_a, masks_b = np.zeros(len(i), dtype=np.int64), [np.zeros(len(i), dtype=bool) for _ in range(most)]
    second = [np.where(b < 0, -2, b).take(j) for b in table]
    for at, a in enumerate(table):
        mine, hit = a.take(i), np.zeros(len(i), dtype=bool)
        for b, theirs_hit in zip(second, masks_b):
            same = mine == b
            hit |= same
            theirs_hit |= same
        mask_a |= hit.astype(np.int64) << at
    mask_b = np.zeros(len(i), dtype=np.int64)
    for at, hit in enumerate(masks_b):
        mask_b |= hit.astype(np.int64) << at
    rests, shared, where = [], [], []
    for at, mask in ((i, mask_a), (j, mask_b)):
        found = pa.array((at.astype(np.int64) << 31) | mask).dictionary_encode()
        made, common = [], []
        for code in found.dictionary.to_pylist():
            k, bits = code >> 31, code & (1 << 31) - 1
            both = {w for n, w in enumerate(kept[k]) if bits >> n & 1} if bits else ()
            made.append(" ".join(w for w in words[k] if w not in both) if both else " ".join(words[k]))
            common.append(sum(map(len, both)) + len(both) - 1 if both else 0)
        rests.append(made), shared.append(np.array(common, dtype=np.int64)), where.append(found.indices.to_numpy().astype(np.int64))
    (rest_a, rest_b), (x, y) = rests, where
    la, lb = (np.array([len(t) for t in r], dtype=np.int64)[w] for r, w in zip(rests, where))
    c = shared[0][x]
    whole_a, whole_b = c + (c > 0) + la, c + (c > 0) + lb
    out = 1 - (la + lb - 2 * lcs_at(rest_a, rest_b, x, y)) / np.maximum(1, whole_a + whole_b)
    best = np.maximum(out, np.maximum(2 * c / np.maximum(c + whole_a, 1), 2 * c / np.maximum(c + whole_b, 1)))
    out = np.where(c > 0, np.where((la == 0) | (lb == 0), 1.0, best), out)
    empty = np.array([not w for w in words])
    return np.where(empty[i] | empty[j], 0.0, out)


def partial(left: list[str], right: list[str]) -> np.ndarray:
    """The best ratio of the shorter string with any window of its length in the longer, or a shorter one at either end."""
    pairs_a, pairs_b, owner = [], [], []
    for i, (a, b) in enumerate(zip(left, right)):
        if not a or not b:
            continue
        for s, t in ([(a, b), (b, a)] if len(a) == len(b) else [(a, b) if len(a) < len(b) else (b, a)]):
            m, held = len(s), set(s)
            for k in range(1 - m, len(t)):
                window = t[max(0, k) : k + m]
                # a window that ends in a character foreign to the shorter string is no better than the one before it
                # (at the right end: one that begins so, than the one after it)
                if (window[-1] if k + m <= len(t) else window[0]) in held:
                    pairs_a.append(window), pairs_b.append(s), owner.append(i)
    out = np.array([float(not a and not b) for a, b in zip(left, right)])
    if owner:
        np.maximum.at(out, np.array(owner), ratios(pairs_a, pairs_b))
    return out


def weighted(left: list[str], right: list[str]) -> np.ndarray:
    """The weighted best of plain, partial, token-sort and token-set ratios, by the ratio of the lengths."""
    out, near, far = np.zeros(len(left)), [], []
    for i, (a, b) in enumerate(zip(left, right)):
        if a and b:
            (near if max(len(a), len(b)) / min(len(a), len(b)) < 1.5 else far).append(i)
    if near:
        a, b = [left[i] for i in near], [right[i] for i in near]
        out[near] = np.maximum(ratios(a, b), 0.95 * np.maximum(ratios(sorted_tokens(a), sorted_tokens(b)), token_set(a, b)))
    if far:
        a, b = [left[i] for i in far], [right[i] for i in far]
        scale = np.array([0.9 if max(len(x), len(y)) / min(len(x), len(y)) <= 8 else 0.6 for x, y in zip(a, b)])
        sets = [(set(x.split()), set(y.split())) for x, y in zip(a, b)]
        set_score = np.array([1.0 if x & y else 0.0 for x, y in sets])
        loose = [k for k, s in enumerate(set_score) if not s]
        if loose:
            set_score[loose] = partial([" ".join(sorted(sets[k][0])) for k in loose], [" ".join(sorted(sets[k][1])) for k in loose])
        best = np.maximum(partial(sorted_tokens(a), sorted_tokens(b)), set_score)
        out[far] = np.maximum(ratios(a, b), np.maximum(scale * partial(a, b), 0.95 * scale * best))
    return out
