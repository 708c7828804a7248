"""Reading and comparing names as people type them.

A name is read into roles (given, middles, surnames, generation suffix); two names are compared by an optimal
assignment of their tokens, in which a token may stand for another by a small edit, as its initial, as an abbreviation
or as a nickname. Everything here is plain Python for one name or one pair; the operators run it inside Arrow batches.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field
from functools import lru_cache

# Common nicknames and written abbreviations of given names (public knowledge). More are learned from
# the tables at run time: from "Nick (Formal)" and official names.
NICKNAMES = """
abigail: abby; abraham: abe; alejandro: ale alex alejo; alexander: alex; anthony: tony; barbara: barb babs; benjamin: ben benny benj;
charles: charlie chuck chas; christopher: chris kit; cynthia: cindy; daniel: dan danny danl; david: dave davey;
deborah: deb debbie; donald: don donnie; dorothy: dot dottie; edward: ed eddie ted edw; eleanor: ellie nell;
elizabeth: beth betsy liz eliz; enrique: quique; eugene: gene; francis: fran frank; francisco: paco pancho fco;
frederick: fred freddie fredk; gabriela: gabby gaby; gerald: gerry jerry; gregory: greg; guadalupe: lupe; henry: hank harry;
ignacio: nacho; isabel: izzy bel; jacqueline: jackie; james: jim jimmy jas; jeffrey: jeff; jennifer: jen jenny;
john: jack johnny; josefina: pepa; joseph: joe joey jos; judith: judy; katherine: kate kathy katie kath kit; kenneth: ken kenny;
lawrence: larry lars; leonard: len lenny; madeleine: maddy; manuel: manny; margaret: maggie meg peggy margt; matthew: matt;
michael: mike mick; natalie: nat; nathaniel: nat nate; nicholas: nick nicky; olivia: liv livvy; pamela: pam; patricia: patty trish;
patrick: paddy pat; penelope: penny; peter: pete; philip: phil; raymond: ray; rebecca: becca becky; richard: dick rick richd;
robert: bob bobby rob robt; ronald: ron ronnie; rosario: charo; samuel: sam sammy saml; sandra: sandy; stephen: steve;
susan: sue susie; theodore: ted teddy theo; theresa: terry tess; thomas: tom tommy thos; timothy: tim; ursula: uschi;
victoria: tori vicky; vincent: vince vinny; virginia: ginny; walter: wally walt; william: bill billy will wm; xavier: xavi;
yolanda: yoli; zachary: zach zack
"""
TITLES = {"mr", "mrs", "ms", "dr", "hon", "rep", "sen", "honorable", "congressman", "congresswoman"}
SUFFIXES = {"jr": "jr", "sr": "sr", "ii": "ii", "iii": "iii", "iv": "iv", "junior": "jr", "senior": "sr", "2nd": "ii", "3rd": "iii"}


def fold(text: str | None) -> str:
    """Without accents, lower case."""
    if not text:
        return ""
    if not text.isascii():
        text = "".join(ch for ch in unicodedata.normalize("NFKD", text) if not unicodedata.combining(ch))
    return text.lower()


_SKELETON = str.maketrans("01vyz5", "oluiss")


@lru_cache(maxsize=200_000)
def skeleton(token: str) -> str:
    """What stays alike when letters are misread or spelled by ear: digits for letters, rn for m, v for u, y for i, z for s."""
    return token.translate(_SKELETON).replace("rn", "m")


def edits(a: str, b: str, most: int) -> int:
    """Edit distance with transpositions of neighbours (optimal string alignment), or most + 1 if it is larger."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    # What both begin and end with plays no part.
    lo, hi = 0, min(len(a), len(b))
    while lo < hi and a[lo] == b[lo]:
        lo += 1
    end = 0
    while end < hi - lo and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[lo : len(a) - end], b[lo : len(b) - end]
    if not a or not b:
        return len(a) + len(b)
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        low = i
        for j, y in enumerate(b, 1):
            v = last[j - 1] if x == y else 1 + min(last[j - 1], last[j], row[j - 1])
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, before[j - 2] + 1)
            row.append(v)
            low = min(low, v)
        if low > most:
            return most + 1
        before, last = last, row
    return min(last[-1], most + 1)


@lru_cache(maxsize=500_000)
def distance(a: str, b: str, most: int = 2) -> int:
    """The edit distance of the tokens; tokens with one skeleton, however often it replaces a letter, are one edit apart."""
    return min(1, edits(a, b, most)) if skeleton(a) == skeleton(b) else edits(a, b, most)


def deletions(token: str) -> set[str]:
    """The token's skeleton and all of it with one letter left out: the keys of the symmetric-delete neighbourhood."""
    s = skeleton(token)
    return {s} | {s[:i] + s[i + 1 :] for i in range(len(s))}


# Longer surname forms meet by parts instead of by deletions, whose number grows with the square of the length.
LONG_FORM = 40


def form_keys(form: str) -> set[str]:
    """Keys of a surname form: two forms that are `alike` share one, whichever letters are damaged.

    One skeleton, or the form with up to one letter left out, from 9 letters on up to two. Of five parts of a long form
    two edits leave one as it is (a transposition may touch two), moved by two places at most."""
    keys, n = {f"~{skeleton(form)}"}, len(form)
    if 4 <= n <= LONG_FORM:
        once = {form[:i] + form[i + 1 :] for i in range(n)}
        keys |= {form} | once
        if n >= 9:
            keys |= {s[:i] + s[i + 1 :] for s in once for i in range(n - 1)}
    if n > LONG_FORM - 2:
        for whole in range(n - 2, n + 1):  # as long as the shorter form of a pair
            for part in range(5):
                start, end = whole * part // 5, whole * (part + 1) // 5
                for move in range(-2, 3):
                    if 0 <= start + move and end + move <= n:
                        keys.add(f"{whole}.{part}.{form[start + move : end + move]}")
    return keys


class GivenNames:
    """What a typed given name can stand for: a vocabulary with nicknames and a symmetric-delete index over both."""

    def __init__(self, formal: set[str], nicknames: dict[str, set[str]], common: str = NICKNAMES):
        """common: `name: nickname nickname; name: ..`, beside the nicknames learned."""
        listed = [part.split(":") for part in common.replace("\n", " ").split(";") if ":" in part]
        self.formal = set(formal) | {name.strip() for name, _ in listed}
        self.nick: dict[str, set[str]] = {}
        for name, nicks in listed:
            for n in nicks.split():
                self.nick.setdefault(n, set()).add(name.strip())
        for n, names in nicknames.items():
            self.nick.setdefault(n, set()).update(names)
        self.index: dict[str, set[str]] = {}
        for name in self.formal | set(self.nick):
            for key in deletions(name):
                self.index.setdefault(key, set()).add(name)
        self.memo: dict[str, frozenset[str]] = {}

    def stands_for(self, token: str) -> frozenset[str]:
        """The formal names that the token may mean; empty if it is none that is known."""
        if (found := self.memo.get(token)) is None:
            if len(self.memo) > 200_000:
                self.memo.clear()
            found = self.memo[token] = frozenset(self._look_up(token))
        return found

    def _look_up(self, token: str) -> set[str]:
        if len(token) < 2:
            return set()
        if token in self.formal:
            return {token}
        if token in self.nick:
            return self.nick[token]
        near: set[str] = set()
        if len(token) >= 3:
            for key in deletions(token):
                near |= {n for n in self.index.get(key, ()) if len(n) > 2 and distance(n, token, 1) <= 1}
        whole = near & self.formal
        if whole:
            return whole
        return set().union(*(self.nick[n] for n in near)) if near else set()


@dataclass(frozen=True)
class Name:
    given: tuple[str, ...] = ()  # one token, or the alternatives typed (nickname and formal name)
    middles: tuple[str, ...] = ()
    surnames: tuple[str, ...] = ()
    suffix: str | None = None
    means: frozenset[str] = field(default=frozenset())  # formal names of the given name

    @property
    def joined(self) -> str:
        return "".join(self.surnames)

    @property
    def initial_only(self) -> bool:
        return not any(len(g) > 1 for g in self.given)

    @property
    def initials(self) -> set[str]:
        return {g[0] for g in self.given} | {m[0] for m in self.means}

    def surname_forms(self) -> set[str]:
        """The surname as a whole (so that a space, hyphen or apostrophe inside doesn't matter), and its longer parts."""
        forms = {p for p in self.surnames if len(p) >= 4}
        for i in range(len(self.surnames) - 1):
            forms.add(self.surnames[i] + self.surnames[i + 1])
        forms.add(self.joined)
        return {f for f in forms if f}

    def keys(self) -> set[str]:
        return set().union(*map(form_keys, self.surname_forms())) if self.surnames else set()


_ASIDE = re.compile(r"\(([^)]*)\)|\"([^\"]*)\"|“([^”]*)”")
_WORD = re.compile(r"[^\W_]+")


def _tokens(text: str) -> list[str]:
    return _WORD.findall(text)


def _letters(token: str) -> str:
    """Digits inside a word were letters."""
    if token.isalpha() or token.isdigit() or token in SUFFIXES:
        return token
    return token.replace("0", "o").replace("1", "l").replace("5", "s")


def read_name(first: str | None, last: str | None, suffix: str | None, given_names: GivenNames) -> Name:
    """A name from its typed fields. Fields may be swapped, hold each other (`Last, First`), titles or the suffix."""
    first, last = fold(first).strip(), fold(last).strip()
    if not last and "," in first:
        last, _, first = first.partition(",")
    elif not first and "," in last:
        last, _, first = last.partition(",")
    gen = None
    for s in _tokens(fold(suffix)):
        gen = SUFFIXES.get(s, gen)
    nick, bare = [], first
    if any(mark in first or mark in last for mark in "(\"“"):
        nick = [t for part in _ASIDE.findall(f"{first} {last}") for p in part for t in _tokens(p)]
        bare, last = _ASIDE.sub(" ", first), _ASIDE.sub(" ", last)

    def words(text: str) -> list[str]:
        nonlocal gen
        found = [_letters(t) for t in _tokens(text)]
        while len(found) > 1 and found[-1] in SUFFIXES:
            gen = SUFFIXES[found.pop()] if gen is None else (found.pop() and gen)
        return found

    def untitled(tokens: list[str], sure: bool) -> list[str]:
        """A title before a surname may be part of it (`Dr-Oapuasert`), so there a given name must follow."""
        while len(tokens) > 1 and tokens[0] in TITLES and (sure or given_names.stands_for(tokens[1])):
            tokens = tokens[1:]
        return tokens

    fore, sur = untitled(words(bare), True), untitled(words(last), False)
    if not fore and len(sur) > 1:
        fore, sur = sur[:-1], sur[-1:]
    if not sur and len(fore) > 1:
        fore, sur = fore[:1] + [t for t in fore[1:-1]], fore[-1:]
    if fore and sur and len(fore[0]) > 1:
        if not given_names.stands_for(fore[0]) and given_names.stands_for(sur[0]) and all(len(t) == 1 or given_names.stands_for(t) or i > 0 for i, t in enumerate(sur)):
            fore, sur = sur, fore
    if fore and len(fore[0]) == 2 and not given_names.stands_for(fore[0]):
        fore = [*fore[0], *fore[1:]]  # two initials in one
    given = tuple(dict.fromkeys([*fore[:1], *nick]))
    means = [given_names.stands_for(g) for g in given if len(g) > 1]
    both = frozenset.intersection(*means) if means and frozenset.intersection(*means) else frozenset().union(*means)
    return Name(given, tuple(fore[1:]), tuple(sur), gen, both)


def learn_nicknames(pairs) -> dict[str, set[str]]:
    """{nickname: formal names} from (formal, nickname) pairs."""
    out: dict[str, set[str]] = {}
    for formal, nick in pairs:
        if formal and nick and formal != nick and len(nick) > 1:
            out.setdefault(nick, set()).add(formal)
    return out


def abbreviates(short: str, long: str) -> bool:
    """`robt` for robert, `fco` for francisco: letters of the long word in order, from its first, much shorter."""
    if not 2 <= len(short) < len(long) or short[0] != long[0] or len(short) > 5:
        return False
    if long.startswith(short):
        return True
    rest = iter(long)
    return len(long) - len(short) >= 2 and all(ch in rest for ch in short)


# How given names agree.
AGREE, PERHAPS, UNKNOWN, CONFLICT = 2, 1, 0, -1


def compare_given(a: Name, b: Name) -> int:
    """AGREE: both written out and the same; PERHAPS: initial, abbreviation or ambiguous nickname; CONFLICT otherwise."""
    if not a.given or not b.given:
        return UNKNOWN
    if a.initial_only or b.initial_only:
        return PERHAPS if a.initials & b.initials else CONFLICT
    if a.means and b.means:
        if shared := a.means & b.means:
            return AGREE if len(shared) == len(a.means) == len(b.means) == 1 or a.given == b.given else PERHAPS
        return CONFLICT
    for x in a.given:
        for y in b.given:
            if x == y or (min(len(x), len(y)) >= 4 and distance(x, y, 1) <= 1) or (min(len(x), len(y)) >= 7 and distance(x, y, 2) <= 2):
                return AGREE
    for x in {*a.given, *a.means}:
        for y in {*b.given, *b.means}:
            if abbreviates(x, y) or abbreviates(y, x) or (len(x) > 3 < len(y) and x[:3] == y[:3]):
                return PERHAPS
    return CONFLICT


def compare_middle(a: Name, b: Name) -> int:
    """By the first middle name: agreement of the word or its initial; unknown where one has none."""
    if not a.middles or not b.middles:
        return UNKNOWN
    x, y = a.middles[0], b.middles[0]
    if len(x) == 1 or len(y) == 1:
        return PERHAPS if x[0] == y[0] else CONFLICT
    return AGREE if distance(x, y, 1) <= 1 else CONFLICT


def compare_suffix(a: Name, b: Name) -> int:
    if a.suffix is None or b.suffix is None:
        return AGREE if a.suffix == b.suffix else UNKNOWN
    return AGREE if a.suffix == b.suffix else CONFLICT


def close(x: str, y: str) -> bool:
    n = min(len(x), len(y))
    return x == y or (n >= 4 and distance(x, y, 1) <= 1) or (n >= 9 and distance(x, y, 2) <= 2)


def alike(x: str, y: str) -> bool:
    """Whether surname forms can be one: what `compare_surname` asks of at least one pair of forms."""
    return skeleton(x) == skeleton(y) or close(x, y)


def compare_surname(a: Name, b: Name) -> int:
    """AGREE: the same as a whole; PERHAPS: the same but for a small edit or a second surname on one side."""
    if not a.surnames or not b.surnames:
        return UNKNOWN
    if skeleton(a.joined) == skeleton(b.joined):
        return AGREE
    if close(a.joined, b.joined):
        return PERHAPS
    fa, fb = a.surname_forms(), b.surname_forms()
    if (len(fa) > 1 or len(fb) > 1) and any(close(x, y) for x in fa for y in fb if min(len(x), len(y)) >= 4):
        # Two double surnames must agree in more than one part.
        if len([p for p in a.surnames if len(p) >= 4]) > 1 and len([p for p in b.surnames if len(p) >= 4]) > 1:
            return PERHAPS if assign(_costs(a.surnames, b.surnames)) <= 1.0 else CONFLICT
        return PERHAPS
    return CONFLICT


def _cost(x: str, y: str) -> float:
    if x == y:
        return 0.0
    if len(x) == 1 or len(y) == 1:
        return 0.4 if x[0] == y[0] else 2.0
    d = distance(x, y, 2)
    if d <= 2 and min(len(x), len(y)) >= 4:
        return 0.3 * d
    return 0.5 if abbreviates(x, y) or abbreviates(y, x) else 2.0


def _costs(xs: tuple[str, ...], ys: tuple[str, ...]) -> list[list[float]]:
    return [[_cost(x, y) for y in ys] for x in xs]


def assign(costs: list[list[float]]) -> float:
    """Least total cost of an assignment of the shorter side to the longer (Hungarian method, any size)."""
    if not costs or not costs[0]:
        return 0.0
    if len(costs) > len(costs[0]):
        costs = [list(c) for c in zip(*costs)]
    n, m = len(costs), len(costs[0])
    u, v, match, way = [0.0] * (n + 1), [0.0] * (m + 1), [0] * (m + 1), [0] * (m + 1)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        least, used = [float("inf")] * (m + 1), [False] * (m + 1)
        while True:
            used[j0] = True
            i0, delta, j1 = match[j0], float("inf"), 0
            for j in range(1, m + 1):
                if not used[j]:
                    c = costs[i0 - 1][j - 1] - u[i0] - v[j]
                    if c < least[j]:
                        least[j], way[j] = c, j0
                    if least[j] < delta:
                        delta, j1 = least[j], j
            for j in range(m + 1):
                if used[j]:
                    u[match[j]] += delta
                    v[j] -= delta
                else:
                    least[j] -= delta
            j0 = j1
            if match[j0] == 0:
                break
        while j0:
            match[j0], j0 = match[way[j0]], way[j0]
    return -v[0]


def alignment_cost(a: Name, b: Name) -> float:
    """Cost per token of the best alignment of all tokens in any order; nicknames count as what they mean."""
    xs = (*a.given[:1], *a.middles, *a.surnames)
    ys = (*b.given[:1], *b.middles, *b.surnames)
    if not xs or not ys:
        return 2.0
    costs = _costs(xs, ys)
    if a.given and b.given and a.means & b.means:
        costs[0][0] = min(costs[0][0], 0.2)
    return assign(costs) / min(len(xs), len(ys))


# What it costs that a given name or surname agrees, agrees perhaps, is unknown or is another one; and that a middle name
# has no counterpart.
_LEVEL_COST = {AGREE: 0.0, PERHAPS: 0.4, UNKNOWN: 0.6, CONFLICT: 2.0}
UNPAIRED = 0.1
# Names whose alignment costs more aren't one person's.
ALIGNED = 0.75


def align(a: Name, b: Name, surname: int | None = None, given: int | None = None) -> float:
    """Cost of the best alignment of two names, by optimal assignment of their tokens in any order.

    A token stands for another by few edits, as its initial or as an abbreviation, a given name also as a nickname, a
    surname as a whole, with its words joined or by one of its words. Middle names may stay without a counterpart. The cost
    is in halves: 1 is one of two names that is another one."""
    xs, ys = (*a.given[:1], *a.middles), (*b.given[:1], *b.middles)
    given_a, given_b = len(a.given[:1]), len(b.given[:1])
    n, m = len(xs) + 1, len(ys) + 1
    # The last row and column are the surnames; behind the columns, each middle name has a place of its own for none.
    costs = [[2.0] * (m + n) for _ in range(n)]
    for i, x in enumerate(xs):
        for j, y in enumerate(ys):
            costs[i][j] = _cost(x, y)
        if len(a.surnames) and len(b.surnames) == 1:
            costs[i][m - 1] = _cost(x, b.surnames[0])
        if i >= given_a:
            costs[i][m + i] = UNPAIRED
    if len(a.surnames) == 1 and b.surnames:
        for j, y in enumerate(ys):
            costs[n - 1][j] = _cost(a.surnames[0], y)
    costs[n - 1][m - 1] = _LEVEL_COST[compare_surname(a, b) if surname is None else surname]
    if given_a and given_b:
        costs[0][0] = _LEVEL_COST[compare_given(a, b) if given is None else given]
    if n == m == 2 and not a.middles and not b.middles and costs[0][0] <= costs[0][1] and costs[1][1] <= costs[1][0]:
        return (costs[0][0] + costs[1][1]) / 2  # each row's least in places of their own
    # Of the other side's middle names those without a counterpart cost as much: all at first, less those that have one.
    for row in costs:
        for j in range(given_b, m - 1):
            row[j] -= UNPAIRED
    return (assign(costs) + UNPAIRED * len(b.middles)) / 2
