"""Whether pairs of texts are within an edit distance, many pairs at a time.

Myers' bit vectors, a public method, in a band: with the longer text downwards, a way of ``most`` edits or fewer stays on
diagonals that leave enough edits to come back from, ``most`` + 1 of them at most, and only these are kept. A column
of the band is two bits a row, and it moves down a row with each letter of the shorter text. Distances along the diagonal that
ends in the last cell never shrink, so a pair is done once they are over its limit. Pairs of about the same numbers of
words of 64 rows take their steps together as arrays, few or very long ones one by one on Python's integers. Before
long texts are compared, words that both hold once, in the same order, are put over each other: if rewriting
all that differs between them stays within the limit, the distance does too. Distances count code points.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np

_ONE, _U = np.uint64(1), np.uint64
#: Words of 64 rows of a band up to which pairs go together, and pairs that do so at a time; fewer than ``FEW`` for each four words go one by one.
WORDS, TOGETHER, FEW = 16, 2048, 24
#: Bands of these numbers of words or fewer, down to the number before, go together.
_CLASSES = np.array([1, 2, 3, 4, 6, 8, 12, 16])
#: Bytes of the letters' places that are held at most, but for one pair's.
PLACES = 1 << 24
#: Code points from which on words are compared first.
LONG = 1280


def _once(words: list[str]) -> dict[str, int]:
    """The places of the words that occur once."""
    at: dict[str, int] = {}
    for i, w in enumerate(words):
        at[w] = -1 if w in at else i
    return at


def _rewritten(a: str, b: str, most: int) -> bool:
    """Whether rewriting what lies between words that both texts hold once is ``most`` edits or fewer; if so, the distance is."""
    x, y = a.split(" "), b.split(" ")
    other = _once(y)
    common = [(i, other[w]) for w, i in _once(x).items() if i >= 0 and other.get(w, -1) >= 0]
    # the longest chain of common words in the order of both texts
    tails: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(common):
        at = len(tails) if not tails or j > tails[-1] else bisect_left(tails, j)
        back.append(ends[at - 1] if at else -1)
        tails[at : at + 1], ends[at : at + 1] = [j], [k]
    chain = [(len(x), len(y))]
    k = ends[-1] if ends else -1
    while k >= 0:
        chain.append(common[k])
        k = back[k]
    cost, i, j = 0, 0, 0
    for n, m in reversed(chain):
        if n - i != m - j or x[i:n] != y[j:m]:
            while i < n and j < m and x[i] == y[j]:
                i, j = i + 1, j + 1
            p, q = n, m
            while i < p and j < q and x[p - 1] == y[q - 1]:
                p, q = p - 1, q - 1
            cost += max(sum(map(len, x[i:p])) + p - i, sum(map(len, y[j:q])) + q - j)
            if cost > most:
                return False
        i, j = n + 1, m + 1
    return True


def _trimmed(a: str, b: str) -> tuple[np.ndarray, np.ndarray]:
    """The code points of the shorter and of the longer text, without what they begin and end with alike."""
    x, y = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in (a, b))
    if len(x) > len(y):
        x, y = y, x
    n = len(x)
    other = np.flatnonzero(x != y[:n])
    head = int(other[0]) if len(other) else n
    other = np.flatnonzero(x[head:][::-1] != y[len(y) - n + head :][::-1])
    tail = int(other[0]) if len(other) else n - head
    return x[head : n - tail], y[head : len(y) - tail]


def _one(x: list[int], y: list[int], most: int) -> bool:
    """For a text x that is as long as y or longer."""
    apart = len(x) - len(y)
    above = (most - apart) // 2
    places: dict[int, int] = {}
    for i, c in enumerate(x):
        places[c] = places.get(c, 0) | 1 << (i + above)
    full, end = (1 << (most + 1)) - 1, 1 << (apart + above)
    more, less, distance = full >> above << above, 0, apart
    for j, c in enumerate(y):
        equal = places.get(c, 0) >> j & full
        diagonal = ((((equal & more) + more) ^ more) | equal | less) & full
        if not diagonal & end:
            distance += 1
            if distance > most:
                return False
        up = less | (full ^ (diagonal | more))
        down = more & diagonal
        diagonal >>= 1
        more, less = down | (full ^ (diagonal | up)), diagonal & up
    return distance <= most


def _letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
    """The letters of all texts as small numbers, each text's followed by the number of letters; where texts begin; that number."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    known = np.zeros(int(codes.max(initial=0)) + 1, bool)
    known[codes] = True
    n, size = int(known.sum()), np.array([len(t) for t in texts], np.int64)
    flat = np.insert((np.cumsum(known) - 1).astype(np.int32)[codes], np.cumsum(size), n)
    return flat, np.cumsum(size + 1) - size - 1, n


def _together(flat: np.ndarray, first: np.ndarray, n_letters: int, x: np.ndarray, y: np.ndarray, xs: np.ndarray, ys: np.ndarray, most: np.ndarray, n_words: int) -> np.ndarray:
    """For pairs of texts x that are as long as y or longer, by their numbers and lengths, none of them empty, whose bands fill up to ``n_words`` words each."""
    n = len(x)
    apart = xs - ys
    above = (most - apart) // 2
    own, at_own, mine = np.unique(x, return_index=True, return_inverse=True)
    size = xs[at_own]
    row = np.repeat(np.arange(len(own)), size)
    place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    letter = flat[first[own][row] + place]
    # letters of the shorter texts that the longer ones lack are equal to none, and what stands behind their ends is to all
    held = np.zeros(n_letters, bool)
    held[letter] = True
    some = int(held.sum())
    of = np.append(np.where(held, np.cumsum(held) - 1, some), some + 1)
    front = (int(above.max()) >> 6) + 1
    high = front + (int(xs.max()) >> 6) + n_words + 2
    places = np.zeros((len(own), some + 2, high), np.uint64)
    places[:, some + 1] = ~_U(0)
    np.add.at(places.reshape(-1), (row * (some + 2) + of[letter]) * high + (place >> 6) + front, _ONE << (place & 63).astype(np.uint64))
    places, of = places.reshape(-1), of * high
    # vertical differences of 1 below the first row, none above
    start = above[None, :] - 64 * np.arange(n_words)[:, None]
    more = np.where(start < 64, ~_U(0) << np.clip(start, 0, 63).astype(np.uint64), _U(0))
    less = np.zeros((n_words, n), np.uint64)
    end = apart + above
    at_word, at_bit = end >> 6, (end & 63).astype(np.uint64)
    alive, out, kept = np.arange(n), np.zeros(n, bool), np.zeros(n, np.int64)
    at = at_word * n + alive
    # where a pair's letters and the word that its band begins in stand
    begin, base, bit = first[y], mine * ((some + 2) * high), 64 * front - above
    nth, top, longest = np.arange(n_words + 1)[:, None], _U(63), int(ys.max())
    for step in range(longest):
        if step & 15 == 0 and step:
            # each step but those that kept the diagonal's distance has added one
            within = apart + step - kept <= most
            on = within & (ys > step)
            if on.sum() < 0.8 * len(on):
                out[alive[within & (ys <= step)]] = True
                alive, ys, most, apart, kept, at_word, at_bit, begin, base, bit = (c[on] for c in (alive, ys, most, apart, kept, at_word, at_bit, begin, base, bit))
                more, less = more[:, on], less[:, on]
                at = at_word * len(alive) + np.arange(len(alive))
                if not len(alive):
                    return out
        down_to = bit + step
        word = base + of.take(flat.take(begin + np.minimum(ys, step))) + (down_to >> 6)
        shift = (down_to & 63).view(np.uint64)
        equal = places.take(word + nth)
        equal = equal[:-1] >> shift | equal[1:] << _ONE << (top - shift)
        if n_words == 1:
            diagonal = (((equal & more) + more) ^ more) | equal | less
            down = more & diagonal
            below = diagonal >> _ONE
        else:
            diagonal, down = np.empty_like(more), np.empty_like(more)
            for w in range(n_words):
                one = equal[w] if not w else equal[w] | down[w - 1] >> top
                diagonal[w] = (((one & more[w]) + more[w]) ^ more[w]) | one | less[w]
                down[w] = more[w] & diagonal[w]
            below = diagonal >> _ONE
            below[:-1] |= diagonal[1:] << top
        kept += (diagonal.reshape(-1).take(at) >> at_bit & _ONE).view(np.int64)
        up = less | ~(diagonal | more)
        more, less = down | ~(below | up), below & up
    out[alive[apart + longest - kept <= most]] = True
    return out


def within(a: list[str], b: list[str], most: np.ndarray) -> np.ndarray:
    """Whether the Levenshtein distance of each a and b is ``most`` or less."""
    number: dict[str, int] = {}
    x, y = (np.array([number.setdefault(t, len(number)) for t in side], np.int64) for side in (a, b))
    texts = list(number)
    size = np.array([len(t) for t in texts], np.int64)
    x, y = np.where(size[x] < size[y], y, x), np.where(size[x] < size[y], x, y)
    longer, shorter = size[x], size[y]
    most = np.minimum(np.asarray(most, np.int64), longer)
    out = most >= longer
    todo = np.flatnonzero((longer - shorter <= most) & ~out)
    quick = [i for i in todo[longer[todo] >= LONG].tolist() if _rewritten(texts[x[i]], texts[y[i]], int(most[i]))]
    out[quick] = True
    todo = todo[~out[todo]]
    n_words = most[todo] // 64 + 1
    # of the longer ones each number of words is its own class
    n_words = np.where(n_words <= WORDS, _CLASSES[np.minimum(np.searchsorted(_CLASSES, n_words), len(_CLASSES) - 1)], n_words)
    # pairs of one longer text stand together, as its letters' places are worked out once
    order = np.lexsort((x[todo], longer[todo], n_words))
    todo, n_words = todo[order], n_words[order]
    flat, first, n_letters = _letters(texts)
    edges = np.append(np.flatnonzero(np.diff(n_words, prepend=-1)), len(todo)).tolist()
    for lo, hi in zip(edges, edges[1:]):
        words = int(n_words[lo])
        while lo < hi:
            chosen = todo[lo : min(hi, lo + TOGETHER)]
            # about as many as have room, by the letters of the first texts
            letters = 2 + len(set("".join(texts[i] for i in x[chosen[:64]].tolist())))
            chosen = chosen[: max(PLACES // (letters * (int(longer[chosen].max()) // 64 + 2 * words + 3) * 8), 1)]
            lo += len(chosen)
            if words <= WORDS and 4 * len(chosen) >= FEW * (words + 3):
                out[chosen] = _together(flat, first, n_letters, x[chosen], y[chosen], longer[chosen], shorter[chosen], most[chosen], words)
            else:
                for i in chosen.tolist():
                    s, t = _trimmed(texts[y[i]], texts[x[i]])
                    out[i] = _one(t.tolist(), s.tolist(), int(most[i]))
    return out


def similar(a: list[str], b: list[str], least: float) -> np.ndarray:
    """Whether the edit similarity of each a and b, 1 - distance / length of the longer, is ``least`` or more."""
    longer = np.array([max(len(s), len(t)) for s, t in zip(a, b)], np.int64)
    return within(a, b, ((1 - least) * longer + 1e-9).astype(np.int64))
