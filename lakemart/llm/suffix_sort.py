"""Deep-shallow sorting of byte strings with their longest common prefixes.

Multikey quicksort orders the strings by chunks down to a shallow depth. Strings that
still agree there go into a blind trie: inner nodes keep only the depth and the bytes
at which their strings part, so an insertion compares with one string, once.
"""

from __future__ import annotations

CHUNK = 8
SHALLOW = 64      # bytes beyond the known common prefix that quicksort looks at
END = -1          # stands for the end of a string, before every byte


def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the longest common prefix; the first ``start`` bytes are known to agree."""
    n = min(len(a), len(b))
    if a[start:n] == b[start:n]:
        return n
    at = start
    while a[at:at + 64] == b[at:at + 64]:
        at += 64
    x, y = a[at:at + 64], b[at:at + 64]
    size = min(len(x), len(y))
    differ = int.from_bytes(x[:size], "big") ^ int.from_bytes(y[:size], "big")
    return at + size - (differ.bit_length() + 7) // 8


class BlindTrie:
    """Order of strings that share their first ``depth`` bytes."""

    def __init__(self, strings: list[bytes], depth: int):
        self.strings, self.depth = strings, depth
        self.root: list | None = None      # [depth, {byte: child}] inside, [None, [string numbers]] at leaves

    def insert(self, number: int) -> None:
        text = self.strings[number]
        if self.root is None:
            self.root = [None, [number]]
            return
        node = self.root
        while node[0] is not None:          # blindly: only the bytes at branching depths are looked at
            byte = text[node[0]] if node[0] < len(text) else END
            node = node[1].get(byte) or next(iter(node[1].values()))
        other = self.strings[node[1][0]]
        shared = common_prefix(text, other, self.depth)
        if shared == len(text) == len(other):
            node[1].append(number)
            return
        mine = text[shared] if shared < len(text) else END
        theirs = other[shared] if shared < len(other) else END
        above, at, node = None, None, self.root
        while node[0] is not None and node[0] < shared:
            above, at = node, text[node[0]]
            node = node[1][at]
        if node[0] == shared:
            node[1][mine] = [None, [number]]
            return
        split = [shared, {mine: [None, [number]], theirs: node}]
        if above is None:
            self.root = split
        else:
            above[1][at] = split

    def ordered(self) -> tuple[list[int], list[int]]:
        """Numbers in order, and the common prefix of each with its forerunner (0 for the first)."""
        order, shared = [], []
        stack = [(self.root, 0)]
        while stack:
            node, before = stack.pop()
            if node[0] is None:
                order += node[1]
                shared += [before] + [len(self.strings[node[1][0]])] * (len(node[1]) - 1)
                continue
            children = [node[1][b] for b in sorted(node[1])]
            stack += [(c, node[0]) for c in children[:0:-1]] + [(children[0], before)]
        return order, shared


def sort(strings: list[bytes], known: int = 0, shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """Order of the strings, and the longest common prefix of each with its forerunner.

    All strings agree in their first ``known`` bytes.
    """
    order: list[int] = []
    shared: list[int] = []

    def put(numbers: list[int], prefixes: list[int]) -> None:
        for k, (number, prefix) in enumerate(zip(numbers, prefixes)):
            if k == 0:
                prefix = common_prefix(strings[order[-1]], strings[number], known) if order else 0
            order.append(number)
            shared.append(prefix)

    stack = [(list(range(len(strings))), known)]
    while stack:
        numbers, depth = stack.pop()
        if len(numbers) == 1:
            put(numbers, [0])
        elif depth >= known + shallow:
            trie = BlindTrie(strings, depth)
            for number in numbers:
                trie.insert(number)
            put(*trie.ordered())
        else:
            pivot = strings[numbers[len(numbers) // 2]][depth:depth + CHUNK]
            less, same, more = [], [], []
            for number in numbers:
                chunk = strings[number][depth:depth + CHUNK]
                (same if chunk == pivot else less if chunk < pivot else more).append(number)
            if more:
                stack.append((more, depth))
            # strings that end inside the chunk are equal; the trie files them together
            stack.append((same, depth + CHUNK if len(pivot) == CHUNK else known + shallow))
            if less:
                stack.append((less, depth))
    return order, shared
