"""Deep-shallow string sorting: vectorised multikey partitioning, then blind tries.

The shallow phase refines groups of strings eight bytes at a time (a multikey
quicksort whose pivot step is one vector sort per eight bytes) and drops a string
as soon as it stands alone.  Groups that still tie at the shallow depth share a
long prefix; each is ordered by a blind trie, which compares a new string in full
with just one string already in it.
"""

from __future__ import annotations

import numpy as np


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differing = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differing.bit_length() + 7) // 8


def blind_trie_order(strings: list[bytes], members) -> tuple[list[int], list[int]]:
    """Members in string order, and each one's common prefix with the one before it.

    An inner node is [depth, {byte or -1 for "ends here": child}]; a leaf is a tuple
    holding the list of members with one and the same string.
    """
    root = None
    for m in members:
        s = strings[m]
        if root is None:
            root = ([m],)
            continue
        node = root
        while isinstance(node, list):
            depth, branches = node
            child = branches.get(s[depth] if depth < len(s) else -1)
            node = child if child is not None else next(iter(branches.values()))
        t = strings[node[0][0]]
        shared = common_prefix(s, t)
        if shared == len(s) == len(t):
            node[0].append(m)
            continue
        above, node = None, root
        while isinstance(node, list) and node[0] < shared:
            above, node = node, node[1][s[node[0]]]
        mine = s[shared] if shared < len(s) else -1
        if isinstance(node, list) and node[0] == shared:
            node[1][mine] = ([m],)
            continue
        theirs = t[shared] if shared < len(t) else -1
        split = [shared, {theirs: node, mine: ([m],)}]
        if above is None:
            root = split
        else:
            above[1][s[above[0]]] = split
    order, lcp, stack, joint = [], [], [(root, 0)], 0
    while stack:
        node, joint = stack.pop()
        if isinstance(node, list):
            depth, branches = node
            children = [branches[b] for b in sorted(branches)]
            stack += [(child, depth) for child in reversed(children[1:])]
            stack.append((children[0], joint))
        else:
            same = node[0]
            order += same
            lcp += [joint] + [len(strings[same[0]])] * (len(same) - 1)
    return order, lcp


def sort_groups(strings: list[bytes], group: np.ndarray, shallow: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of all strings by (group, string), and each one's common prefix with its forerunner.

    The prefix length is -1 for the first string of a group.
    """
    n, wide = len(strings), shallow // 8
    padded = np.frombuffer(b"".join(s[:shallow].ljust(shallow, b"\0") for s in strings), dtype=">u8").reshape(n, wide)
    lengths = np.array([len(s) for s in strings], dtype=np.int64)
    order = np.argsort(group, kind="stable")
    lcp = np.full(n, -1, dtype=np.int64)
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = group[order][1:] != group[order][:-1]
    for w in range(wide):
        run = np.cumsum(fresh)
        tied = ~fresh
        tied[:-1] |= ~fresh[1:]
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        word = padded[order[slots], w].astype(np.uint64)
        by = np.lexsort((word, run[slots]))
        order[slots] = order[slots][by]
        word, here = word[by], run[slots]
        new = np.flatnonzero((here[1:] == here[:-1]) & (word[1:] != word[:-1])) + 1
        differing = word[new] ^ word[new - 1]
        equal = np.zeros(len(new), dtype=np.int64)
        for byte in range(1, 8):
            equal += differing < np.uint64(1 << (64 - 8 * byte))
        fresh[slots[new]] = True
        lcp[slots[new]] = w * 8 + equal
    starts = np.flatnonzero(fresh)
    sizes = np.diff(np.append(starts, n))
    for at, size in zip(starts[sizes > 1], sizes[sizes > 1], strict=True):
        ordered, shared = blind_trie_order(strings, order[at:at + size].tolist())
        order[at:at + size] = ordered
        lcp[at + 1:at + size] = shared[1:]
    inner = np.flatnonzero(lcp >= 0)
    lcp[inner] = np.minimum(lcp[inner], np.minimum(lengths[order[inner]], lengths[order[inner - 1]]))
    return order, lcp
