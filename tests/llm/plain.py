"""Plain computations of what the operators return, for small tables."""

import base64
import collections
import hashlib
import re
import zlib

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def tiktoken_encoding():
    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n if n < 10 else n - 9
    return total % 10 == 0


def base_pii(text: str) -> list[str]:
    def digits(s):
        return re.sub("[^0-9]", "", s)

    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
    ]
    return [f"{k}:{m.start()}:{m.end()}" for k, p, ok in rules for m in re.finditer(p, text) if ok(m.group())]


def shingle_set(text: str) -> frozenset:
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def near_components(texts: dict, percent: int = 85) -> dict:
    """id -> smallest id reachable over pairs of at least ``percent``, by comparing all pairs that share a shingle."""
    sets = {i: shingle_set(t) for i, t in texts.items()}
    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for ids in holders.values():
        for i in ids:
            for j in ids:
                if i < j and root(i) != root(j):
                    shared = len(sets[i] & sets[j])
                    if 100 * shared >= percent * len(sets[i] | sets[j]):
                        a, b = sorted((root(i), root(j)))
                        parent[b] = a
    return {i: root(i) for i in sets}


def exact_groups(rows: list[tuple]) -> dict:
    """normalised text -> (keep id, size), from (id, text)."""
    groups = collections.defaultdict(list)
    for i, text in rows:
        groups[SPACE.sub("", text or "")].append((-len(text or ""), i is None, i or 0, i))
    return {body: (min(g)[3], len(g)) for body, g in groups.items()}


def crc(text) -> int:
    return zlib.crc32((text or "").encode())
