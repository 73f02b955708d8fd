"""Token ids by a public vocabulary of the ``tokenizers`` library, with words remembered between texts.

Both vocabularies cut a text into pieces before they merge, and no piece reaches from a character that is
not white space over a space or line feed that follows it. So a text may be cut in front of every such
space, its parts encoded one by one, and the ids put end to end; equal parts have equal ids. A text
with any other white space character is encoded whole instead. Vocabulary files are read on the executors
from the path given.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from orderloom.llm.common import remembers, serve

# White space and separators other than space and line feed, for any library's idea of them.
ODD_SPACE = "[\\t\\r\\x0b\\x0c\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{180e}\\x{2000}-\\x{200f}\\x{2028}-\\x{202f}\\x{205f}-\\x{2064}\\x{3000}\\x{feff}]"
BETWEEN = "\x1f"  # one of the odd ones, so free to mark cuts with
# In each of two generations; a part takes some 220 bytes.
MOST_PARTS = 700_000
LONG_PART = 100
# For a worker that shares its executor with the full heap of earlier stages: fewer parts, and fewer rows at once.
LEAN_PARTS = 200_000
ROWS, LEAN_ROWS = 1024, 256


class Vocabulary:
    """Encodes texts; parts and their ids (little-endian unsigned 16 bit) are remembered in two generations.

    When the younger generation is full it becomes the elder one, and what the elder one held is forgotten.
    A part found in the elder one moves to the younger, so parts in use stay. Names of special tokens inside a
    text are ordinary text if ``plain_names``, else they get the ids of those tokens, which is the library's default.
    ``most_parts`` is the size of a generation (``MOST_PARTS``); the ids do not depend on it.
    """

    def __init__(self, path: str, drops_space: bool, plain_names: bool = True, most_parts: int | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_names
        # No part may cut one of these names.
        if not plain_names and any(set(token.content) & set(" \n") for token in self.tokenizer.get_added_tokens_decoder().values()):
            raise ValueError("names of special tokens must not hold white space")
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids must fit in 16 bits")
        self.drops_space, self.most_parts = drops_space, most_parts or MOST_PARTS
        self.young: dict[str, bytes] = {}
        self.elder: dict[str, bytes] = {}
        self.ends = {c: array("H", self.tokenizer.encode(c, add_special_tokens=False).ids).tobytes() for c in ".,"}

    def _learn(self, parts: list[str]) -> list[bytes]:
        """Encode parts that are not remembered, and remember them."""
        out = []
        for start in range(0, len(parts), 4096):
            encoded = self.tokenizer.encode_batch_fast(parts[start : start + 4096], add_special_tokens=False)
            out += [array("H", got.ids).tobytes() for got in encoded]
        self.young.update(zip(parts, out, strict=True))
        return out

    def _of(self, parts: list[str]) -> list[bytes]:
        """The ids of distinct parts."""
        young, elder = self.young, self.elder
        found = list(map(young.get, parts))
        new, tails = [], []
        for k in [k for k, got in enumerate(found) if got is None]:
            part = parts[k]
            got = elder.get(part)
            if got is not None:
                found[k] = young[part] = got
            # A full stop or comma after a letter or digit is a piece of its own.
            elif part[-1:] in (".", ",") and "0" <= part[-2:-1] <= "\u00ff" and part[-2].isalnum():
                tails.append(k)
            else:
                new.append(k)
        for k, ids in zip(new, self._learn([parts[k] for k in new]), strict=True):
            found[k] = ids
        bases = {parts[k][:-1] for k in tails}
        self._learn([part for part in bases if part not in young and part not in elder])
        for k in tails:
            part = parts[k]
            base = young.get(part[:-1])
            found[k] = young[part] = (elder[part[:-1]] if base is None else base) + self.ends[part[-1]]
        for part in [part for part in (*(parts[k] for k in new), *bases) if len(part) > LONG_PART]:
            young.pop(part, None)
        if len(young) > self.most_parts:
            self.elder, self.young = young, {}
        return found

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of every text; none for a null or empty one."""
        own = texts.fill_null("")
        odd = pc.match_substring_regex(own, ODD_SPACE)
        whole = (odd if self.drops_space else pc.or_(odd, pc.match_substring_regex(own, "[ \\n][ \\n]"))).to_pylist()
        if self.drops_space:
            cut = pc.replace_substring(pc.replace_substring(own, "\n", BETWEEN), " ", BETWEEN)
        else:
            cut = pc.replace_substring(pc.replace_substring(own, "\n", f"{BETWEEN}\n"), " ", f"{BETWEEN} ")
        parts = pc.split_pattern(cut, BETWEEN)
        if any(whole):
            parts = pa.array([[t] if w else p for t, w, p in zip(own.to_pylist(), whole, parts.to_pylist(), strict=True)], pa.list_(pa.string()))
        coded = parts.flatten().dictionary_encode()
        ids = self._of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        flat = np.frombuffer(b"".join(ids), "<u2")
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 2
        starts = np.cumsum(sizes) - sizes
        which = coded.indices.to_numpy()
        each = sizes[which]
        ends = np.cumsum(each)
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts[which] - ends + each, each)
        edges = np.concatenate([[0], ends])[np.asarray(parts.offsets) - parts.offsets[0].as_py()]
        out = flat[at].tobytes()
        return [out[2 * a : 2 * b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


_OPEN: dict[tuple[str, bool, bool, int | None], Vocabulary] = {}
remembers("vocabulary", _OPEN.clear)


def vocabulary(path: str, drops_space: bool, plain_names: bool = True, most_parts: int | None = None) -> Vocabulary:
    """The vocabulary of a file, opened once per Python worker that serves no other operator in between."""
    serve("vocabulary")
    key = path, drops_space, plain_names, most_parts
    if key not in _OPEN:
        _OPEN[key] = Vocabulary(*key)
    return _OPEN[key]


def joined(batches: Iterator[pa.RecordBatch], rows: int = ROWS, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Neighbouring batches put together, up to a number of rows and bytes, so that more parts are shared."""
    held, n, total = [], 0, 0
    for batch in batches:
        held.append(batch)
        n, total = n + batch.num_rows, total + batch.nbytes
        if n >= rows or total >= size:
            yield pa.concat_batches(held)
            held, n, total = [], 0, 0
    if held:
        yield pa.concat_batches(held)
