import itertools
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm import names as N

G = N.GivenNames({"vera", "una", "lloyd"}, {"bobbo": {"robert"}})
read = lambda first, last="", suffix=None: N.read_name(first, last, suffix, G)


@pytest.mark.parametrize(
    ("fields", "given", "middles", "surnames", "suffix"),
    [
        (("Ms. Daniel", "Stone"), ("daniel",), (), ("stone",), None),
        (("Yarrow", "David"), ("david",), (), ("yarrow",), None),
        (("Stone, Henry J.", ""), ("henry",), ("j",), ("stone",), None),
        (('"Tony" Anthony', "Bay"), ("anthony", "tony"), (), ("bay",), None),
        (("Len (Leonard) P.", "Bay"), ("len", "leonard"), ("p",), ("bay",), None),
        (("D. Merle", "Bucky"), ("d",), ("merle",), ("bucky",), None),
        (("J.R.", "O'Neil"), ("j",), ("r",), ("o", "neil"), None),
        (("Zelda", "Zuask Jr."), ("zelda",), (), ("zuask",), "jr"),
        (("Grymet", "Lloyd E."), ("lloyd",), ("e",), ("grymet",), None),
        (("JI.", "Koyl"), ("j",), ("i",), ("koyl",), None),
        (("Matt", "Dr-Oapua"), ("matt",), (), ("dr", "oapua"), None),
        ((None, None), (), (), (), None),
        (("", "  "), (), (), (), None),
    ],
)
def test_reading(fields, given, middles, surnames, suffix):
    n = read(*fields)
    assert (n.given, n.middles, n.surnames, n.suffix) == (given, middles, surnames, suffix)


@pytest.mark.parametrize(
    ("a", "b", "level"),
    [
        ("Tony", "Anthony", N.AGREE), ("Robt.", "Robert", N.AGREE), ("Vra", "Vera", N.AGREE), ("Tony", "Thomas", N.CONFLICT), ("R.", "Bob", N.PERHAPS), ("R.", "Vera", N.CONFLICT),
        ("Nat", "Natalie", N.PERHAPS), ("R0bert", "Robert", N.AGREE), ("Francis", "Francisco", N.CONFLICT), ("", "Bob", N.UNKNOWN), ("Xyloph", "Xylophe", N.AGREE), ("Bobbo", "Robert", N.AGREE),
    ],
)
def test_given_names(a, b, level):
    assert N.compare_given(read(a, "Stone"), read(b, "Stone")) == level == N.compare_given(read(b, "Stone"), read(a, "Stone"))


@pytest.mark.parametrize(
    ("a", "b", "level"),
    [("Relveeram", "Relv-Eeram", 2), ("Relveeram", "Relveram", 1), ("Relveeram-Jie", "Relveeram", 1), ("Stone", "Flint", -1), ("Caulmeolel", "Caulrneolel", 2), ("Danaagvlf", "Danaagulf", 2), ("", "Stone", 0), ("Dollay", "Dollaay", 1)],
)
def test_surnames(a, b, level):
    assert N.compare_surname(read("Bob", a), read("Bob", b)) == level


def test_middles_and_suffixes():
    assert N.compare_middle(read("Bob J.", "S"), read("Bob Jude", "S")) == N.PERHAPS and N.compare_middle(read("Bob J.", "S"), read("Bob K.", "S")) == N.CONFLICT
    assert N.compare_suffix(read("B", "S", "Jr."), read("B", "S", "Sr.")) == N.CONFLICT and N.compare_suffix(read("B", "S", "Jr."), read("B", "S")) == N.UNKNOWN


def brute(a, b):
    """Optimal string alignment, straight from its definition."""
    d = {(i, j): i + j for i in range(len(a) + 1) for j in range(len(b) + 1) if not i or not j}
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


@settings(max_examples=300, deadline=None)
@given(st.text("abc", max_size=8), st.text("abc", max_size=8))
def test_edit_distance(a, b):
    assert N.edits(a, b, 3) == min(4, brute(a, b))


@settings(max_examples=300, deadline=None)
@given(st.text("abcdn", min_size=1, max_size=9), st.text("abcdn", min_size=1, max_size=9))
def test_deletion_keys_find_all_single_edits(a, b):
    if brute(a, b) <= 1:
        assert N.deletions(a) & N.deletions(b)


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 5), st.integers(1, 5), st.integers(0, 10_000))
def test_assignment_is_optimal(n, m, seed):
    r = random.Random(seed)
    c = [[r.randint(0, 9) for _ in range(m)] for _ in range(n)]
    short = c if n <= m else [list(x) for x in zip(*c)]
    best = min(sum(short[i][p[i]] for i in range(len(short))) for p in itertools.permutations(range(len(short[0])), len(short)))
    assert abs(N.assign(c) - best) < 1e-9


@pytest.mark.parametrize("base", ["ruan", "arnold", "brualliac", "holviddett", "arnoldsrnen", "x" * 39, "abcdefghijklmnopqrstuvwxyz" * 2, "y" * 50_000])
def test_alike_forms_share_a_key(base):
    """Whichever letters are damaged: up to two edits at any place, transpositions and misread `rn` included."""
    r = random.Random(7)

    def damage(word):
        i, kind = r.randrange(len(word) - 1), r.randrange(5)
        return [word[:i] + word[i + 1 :], word[:i] + "q" + word[i:], word[:i] + "q" + word[i + 1 :], word[:i] + word[i + 1] + word[i] + word[i + 2 :], word.replace("rn", "m", 1)][kind]

    keys = N.form_keys(base)
    assert len(keys) < 900
    for _ in range(400 if len(base) < 100 else 3):
        once = damage(base)
        for word in (once, damage(once)) if len(once) > 1 else (once,):
            if len(base) > 100 or N.alike(base, word):
                assert keys & N.form_keys(word), word
