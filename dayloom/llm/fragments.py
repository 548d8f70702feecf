"""The monoid of alignment fragments: stretches of two token sequences over the same bytes, cut where both end.

A token is (id, end), ``end`` the offset of the byte behind it. A ``Fragment`` is what is known of a range of bytes on its own: the
tokens that end there, up to the first place where both sequences end (``prefix``, open to the left), those after the last
such place (``suffix``, open to the right), and the whole groups between, in ``closed``. Without such a place all tokens are prefix.
``joined`` puts neighbours together; it is associative, so fragments of a text can be joined in any tree.
"""

from __future__ import annotations

from typing import NamedTuple

Tokens = list[tuple[int, int]]
PAIR = 32  # a pair of ids is one long, the second in the lower bits


class Open(NamedTuple):
    a: Tokens
    b: Tokens


class Closed(NamedTuple):
    """Whole groups: counts, their text ``a1,a2|b1;a3|b2,b3``, and a pair of ids for each link."""

    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    body: bytes
    pairs: list[int]


class Fragment(NamedTuple):
    prefix: Open
    cut: bool
    closed: list[Closed]
    suffix: Open


NOTHING = Fragment(Open([], []), False, [], Open([], []))


def group(tokens: Open) -> Closed:
    """The tokens of one group; two of them are linked where their bytes overlap."""
    a, b = tokens
    pairs, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        pairs.append(a[i][0] << PAIR | b[j][0])
        end_a, end_b = a[i][1], b[j][1]
        i += end_a <= end_b
        j += end_b <= end_a
    body = ",".join(str(t[0]) for t in a) + "|" + ",".join(str(t[0]) for t in b)
    return Closed(len(a), len(b), 1, len(pairs), body.encode(), pairs)


def fragment(a: Tokens, b: Tokens) -> Fragment:
    """The fragment of all tokens that end within a range of bytes."""
    opens, i, j = [Open([], [])], 0, 0
    while i < len(a) or j < len(b):
        end_a = a[i][1] if i < len(a) else None
        end_b = b[j][1] if j < len(b) else None
        if end_b is None or end_a is not None and end_a <= end_b:
            opens[-1].a.append(a[i])
            i += 1
        if end_a is None or end_b is not None and end_b <= end_a:
            opens[-1].b.append(b[j])
            j += 1
        if end_a == end_b:
            opens.append(Open([], []))
    if len(opens) == 1:
        return Fragment(opens[0], False, [], Open([], []))
    return Fragment(opens[0], True, [group(o) for o in opens[1:-1]], opens[-1])


def _both(x: Open, y: Open) -> Open:
    return Open(x.a + y.a, x.b + y.b)


def seam(left: Open, right: Open) -> list[Closed]:
    """What an open suffix and the prefix behind it make, where that is any token."""
    whole = _both(left, right)
    return [group(whole)] if whole.a or whole.b else []


def joined(x: Fragment, y: Fragment) -> Fragment:
    if not x.cut:
        return Fragment(_both(x.prefix, y.prefix), y.cut, y.closed, y.suffix)
    if not y.cut:
        return Fragment(x.prefix, True, x.closed, _both(x.suffix, y.prefix))
    return Fragment(x.prefix, True, x.closed + seam(x.suffix, y.prefix) + y.closed, y.suffix)


def whole(x: Fragment) -> list[Closed]:
    """The groups of a fragment that begins and ends with its text."""
    return seam(Open([], []), x.prefix) + x.closed
