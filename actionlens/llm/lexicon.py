"""Lexicon of words with id outputs as a minimal acyclic transducer in one memory-mapped file.

Words that end alike share the states of their endings. Every arc carries how many words of its state
come before those behind it; added up along a word these numbers give the word's place in the lexicon, and the
place gives its ids. Compiled once, the automaton is a flat array of numbers that tasks map into memory
and walk for many words at a time.
"""

from __future__ import annotations

import io

import numpy as np
from pyspark import SparkFiles
from pyspark.sql import SparkSession

from ..session import scratch_folder

_SECTIONS = ("arc_keys", "arc_targets", "arc_skips", "final", "id_ends", "ids")


class Lexicon:
    """Arcs sorted by state and byte. ``final`` tells for each state whether a word ends there;
    ``id_ends`` has, by a word's place, where its ids end, after a leading zero."""

    def __init__(self, flat: np.ndarray):
        sizes = flat[: len(_SECTIONS)].tolist()
        ends = np.cumsum([len(_SECTIONS), *sizes]).tolist()
        for name, low, high in zip(_SECTIONS, ends[:-1], ends[1:]):
            setattr(self, name, flat[low:high])

    @property
    def words(self) -> int:
        return len(self.id_ends) - 1

    @property
    def states(self) -> int:
        return len(self.final)

    def places(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Place in the lexicon of each word ``data[start:end]``, or -1. All words go on by one byte at a time."""
        out = np.full(len(starts), -1, np.int64)
        if not len(self.arc_keys):
            return np.where((starts == ends) & bool(self.final[0]), 0, out)
        word, state, place, at = np.arange(len(starts)), np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64), starts.astype(np.int64)
        while len(word):
            done = at == ends[word]
            here = word[done]
            out[here] = np.where(self.final[state[done]] > 0, place[done], -1)
            word, state, place, at = (x[~done] for x in (word, state, place, at))
            key = (state << 8) | data[at]
            arc = np.minimum(np.searchsorted(self.arc_keys, key.astype(np.uint32)), len(self.arc_keys) - 1)
            known = self.arc_keys[arc] == key
            word, arc, place, at = word[known], arc[known], place[known], at[known] + 1
            state, place = self.arc_targets[arc].astype(np.int64), place + self.arc_skips[arc]
        return out


def compile_lexicon(entries: dict[bytes, list[int]]) -> np.ndarray:
    """The automaton of all ``entries`` as one array for ``Lexicon``.

    Words are added in order. Once the next word leaves a branch, the branch can change no more, and
    each of its states, from the last one on, is replaced by an equal one that is already known.
    """
    words = sorted(entries)
    known: dict[tuple, int] = {}
    counts: list[int] = []
    made: list[tuple] = []
    # The states of the word added last that may still change: whether a word ends there, and arcs.
    path: list[list] = [[False, []]]

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, arcs = path.pop()
            state = (final, tuple(arcs))
            number = known.get(state)
            if number is None:
                number = known[state] = len(made)
                made.append(state)
                counts.append(final + sum(counts[target] for _, target in arcs))
            last = path[-1][1]
            last[-1] = (last[-1][0], number)

    before = b""
    for word in words:
        shared = 0
        while shared < min(len(word), len(before)) and word[shared] == before[shared]:
            shared += 1
        close(shared)
        for byte in word[shared:]:
            path[-1][1].append((byte, -1))
            path.append([False, []])
        path[-1][0] = True
        before = word
    close(0)
    # The first state comes first; the others follow in the order in which they were closed.
    states = [(path[0][0], tuple(path[0][1])), *made]
    keys, targets, skips = [], [], []
    for number, (final, arcs) in enumerate(states):
        skipped = int(final)
        for byte, target in arcs:
            keys.append(number << 8 | byte)
            targets.append(target + 1)
            skips.append(skipped)
            skipped += counts[target]
    ids = [entries[w] for w in words]
    sections = [keys, targets, skips, [int(f) for f, _ in states], np.cumsum([0, *map(len, ids)]), [i for x in ids for i in x]]
    return np.concatenate([np.array(x, np.uint32) for x in ([len(x) for x in sections], *sections)])


def publish(spark: SparkSession, flat: np.ndarray) -> str:
    """Write the array to the shared folder and send the file to every executor; gives its name."""
    path = f"{scratch_folder(spark)}.npy"
    content = io.BytesIO()
    np.save(content, flat)
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(context._jsc.hadoopConfiguration()).create(target)
    stream.write(bytearray(content.getvalue()))
    stream.close()
    context.addFile(path)
    return path.rpartition("/")[2]


def open_published(name: str) -> Lexicon:
    """The lexicon of a published file, mapped into memory."""
    return Lexicon(np.load(SparkFiles.get(name), mmap_mode="r"))
