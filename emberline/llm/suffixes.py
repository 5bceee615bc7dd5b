"""Deep-shallow sorting of strings: multikey quicksort to a shallow depth, then blind tries."""

from __future__ import annotations

SHALLOW = 4


def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, known to be at least ``start``."""
    n = min(len(a), len(b))
    if a[start:n] == b[start:n]:
        return n
    lo, hi = start, n  # equal up to lo, not up to hi
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


class BlindTrie:
    """Patricia trie whose nodes keep a depth and branches by one byte (-1: the string ends there).

    An insertion walks down blindly, compares with any leaf below once, and branches where they part.
    """

    __slots__ = ("strings", "root")

    def __init__(self, strings: list[bytes]):
        self.strings, self.root = strings, None

    def insert(self, i: int) -> None:
        s = self.strings[i]
        if self.root is None:
            self.root = ([i], None)
            return
        node = self.root
        while node[1] is not None:
            depth, branches = node
            node = branches.get(s[depth] if depth < len(s) else -1) or next(iter(branches.values()))
        other = self.strings[node[0][0]]
        parts = common_prefix(s, other)
        if parts == len(s) == len(other):
            node[0].append(i)
            return
        at, up, key = self.root, None, None
        while at[1] is not None and at[0] < parts:
            up, key = at, s[at[0]] if at[0] < len(s) else -1
            at = at[1][key]
        own = s[parts] if parts < len(s) else -1
        if at[1] is not None and at[0] == parts:
            at[1][own] = ([i], None)
            return
        new = (parts, {own: ([i], None), other[parts] if parts < len(other) else -1: at})
        if up is None:
            self.root = new
        else:
            up[1][key] = new

    def walk(self) -> list[tuple[int, int]]:
        """(index, common prefix with the one before) in order; the first has -1."""
        out, stack, lcp = [], [(self.root, -1)], -1
        while stack:
            node, lcp = stack.pop()
            if node[1] is None:
                whole = len(self.strings[node[0][0]])
                out += [(i, lcp if n == 0 else whole) for n, i in enumerate(node[0])]
            else:
                keys = sorted(node[1], reverse=True)
                stack += [(node[1][k], node[0]) for k in keys[:-1]]
                stack.append((node[1][keys[-1]], lcp))
        return out


def deep_shallow_sort(strings: list[bytes], shallow: int = SHALLOW) -> list[tuple[int, int]]:
    """(index, length of the common prefix with the string before) in sorted order; the first has -1."""
    out: list[tuple[int, int]] = []
    # (indices that agree up to depth, depth, common prefix with what comes before them)
    stack = [(list(range(len(strings))), 0, -1)]
    while stack:
        group, depth, lcp = stack.pop()
        if not group:
            continue
        if len(group) == 1:
            out.append((group[0], lcp))
        elif depth >= shallow:
            trie = BlindTrie(strings)
            for i in group:
                trie.insert(i)
            found = trie.walk()
            out.append((found[0][0], lcp))
            out += found[1:]
        else:
            byte = lambda i: strings[i][depth] if depth < len(strings[i]) else -1  # noqa: E731, B023
            pivot = byte(group[len(group) // 2])
            less, same, more = [], [], []
            for i in group:
                b = byte(i)
                (less if b < pivot else same if b == pivot else more).append(i)
            # Only the first part inherits the prefix shared with what came before.
            first = lcp
            parts = []
            for part, deeper in ((less, depth), (same, shallow if pivot < 0 else depth + 1), (more, depth)):
                if part:
                    parts.append((part, deeper, first))
                    first = depth
            stack += reversed(parts)
    return out
