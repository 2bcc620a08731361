"""Bounded per-worker caches over public tokenizer files; loaded once in each Python worker."""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterable

_loaded: dict[tuple, object] = {}


def once(key: tuple, make: Callable):
    """What ``make`` returns, kept for the life of the worker process."""
    if key not in _loaded:
        _loaded[key] = make()
    return _loaded[key]


def tokenizer(path: str):
    """A tokenizer of the ``tokenizers`` library, without padding, truncation or threads."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

    def make():
        from tokenizers import Tokenizer

        loaded = Tokenizer.from_file(path)
        loaded.no_padding()
        loaded.no_truncation()
        return loaded

    return once(("tokenizers", path), make)


def ranked(path: str, pattern: str):
    """The tiktoken encoder of a rank file."""

    def make():
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        return tiktoken.Encoding("ranked", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    return once(("tiktoken", path, pattern), make)


class Memory:
    """A bounded map that keeps recent entries: two generations, the older one dropped when full."""

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}

    def missing(self, keys: Iterable) -> list:
        """The keys it doesn't know; those of the older generation are taken over."""
        unknown = set(keys) - self.young.keys()
        known = unknown & self.old.keys()
        for key in known:
            self.young[key] = self.old[key]
        return list(unknown - known)

    def add(self, pairs: Iterable[tuple]) -> None:
        self.young.update(pairs)

    def trim(self) -> None:
        """Call when no lookup is under way."""
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
