from hypothesis import given, settings
from hypothesis import strategies as st

from tesserae.functions import kernel as K

WORDS = st.text(alphabet="abc é ", max_size=80)


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(WORDS, WORDS), max_size=8))
def test_lcs_equals_dynamic_programming(pairs):
    a, b = [p[0] for p in pairs], [p[1] for p in pairs]
    assert K.lcs_lengths(a, b).tolist() == [lcs(x, y) for x, y in pairs]


def test_known_lengths():
    assert K.lcs_lengths(["abcbdab", "kitten", "acme solutions"], ["bdcaba", "sitting", "acme solution"]).tolist() == [4, 4, 13]


@settings(max_examples=50, deadline=None)
@given(st.text(alphabet="ab c", min_size=1, max_size=12), st.text(alphabet="ab c", min_size=1, max_size=12))
def test_partial_equals_all_windows(a, b):
    def best(s, t):
        m = len(s)
        return max(2 * lcs(s, t[max(0, k) : k + m]) / (m + len(t[max(0, k) : k + m])) for k in range(1 - m, len(t)))

    short, long = sorted((a, b), key=len)
    wanted = max(best(a, b), best(b, a)) if len(a) == len(b) else best(short, long)
    assert abs(K.partial([a], [b])[0] - wanted) < 1e-12


def test_token_scores():
    assert K.token_set(["a b c", "x"], ["c b a d", "y"]).tolist() == [1.0, 0.0]
    assert K.ratios(K.sorted_tokens(["b a"]), K.sorted_tokens(["a b"])).tolist() == [1.0]
    assert 0 <= K.weighted(["acme foods ltd of london"], ["acme"])[0] <= 1


def plain_ratio(a, b):
    return 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


def plain_partial(a, b):
    def best(s, t):
        m = len(s)
        return max(plain_ratio(s, t[max(0, k) : k + m]) for k in range(1 - m, len(t)))

    short, long = sorted((a, b), key=len)
    return max(best(a, b), best(b, a)) if len(a) == len(b) else best(short, long)


def plain_weighted(a, b):
    """The weighted score by its public definition, all parts by plain loops."""
    ordered = lambda words: " ".join(sorted(words))
    if not a or not b:
        return 0.0
    x, y = set(a.split()), set(b.split())
    by = max(len(a), len(b)) / min(len(a), len(b))
    if by < 1.5:
        sort = plain_ratio(ordered(a.split()), ordered(b.split()))
        common, left, right = ordered(x & y), ordered(x - y), ordered(y - x)
        if not x or not y:
            whole = 0.0
        elif common and (not left or not right):
            whole = 1.0
        else:
            with_left, with_right = (f"{common} {left}".strip(), f"{common} {right}".strip())
            whole = plain_ratio(with_left, with_right)
            if common:
                whole = max(whole, plain_ratio(common, with_left), plain_ratio(common, with_right))
        return max(plain_ratio(a, b), 0.95 * sort, 0.95 * whole)
    scale = 0.9 if by <= 8 else 0.6
    tokens = max(plain_partial(ordered(a.split()), ordered(b.split())), 1.0 if x & y else plain_partial(ordered(x), ordered(y)))
    return max(plain_ratio(a, b), scale * plain_partial(a, b), 0.95 * scale * tokens)


TOKENS = st.lists(st.text(alphabet="abcd", min_size=1, max_size=5), min_size=1, max_size=5).map(" ".join)


@settings(max_examples=200, deadline=None)
@given(TOKENS, TOKENS)
def test_weighted_equals_its_definition(a, b):
    assert abs(K.weighted([a], [b])[0] - plain_weighted(a, b)) < 1e-12
