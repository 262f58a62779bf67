"""Tokenizing by independent fragments.  A text is cut where no token can
span, the distinct fragments of a slice are encoded once by the ``tokenizers``
library (with a bounded memo per worker), and a text's ids are its fragments'
ids, concatenated.  The tokenizer travels as its JSON text (a broadcast of
fixed size), so executors need no file of their own."""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from dataclasses import dataclass
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from threadloom.llm.textbuf import buffers

#: Fragments a worker remembers at most; the rest is encoded again when met.
MEMO_ENTRIES = 300_000
_PER_WORKER: dict[str, "Encoder"] = {}


@dataclass(frozen=True)
class TokenizerFile:
    """A ``tokenizers`` JSON file by content."""

    text: str

    @classmethod
    def read(cls, path: str) -> "TokenizerFile":
        with open(path, encoding="utf-8") as f:
            return cls(f.read())

    @property
    def version(self) -> str:
        return hashlib.sha256(self.text.encode()).hexdigest()

    @property
    def vocabulary_size(self) -> int:
        spec = json.loads(self.text)
        return 1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])


class Encoder:
    """Ids of fragments as little-endian uint32 bytes."""

    def __init__(self, text: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(text)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memo: dict[str, bytes] = {"": b""}

    def encode(self, fragments: list[str]) -> list[bytes]:
        out = list(map(self.memo.get, fragments))
        new = [f for f, known in zip(fragments, out) if known is None]
        if not new:
            return out
        ids = self.encode_new(new)
        room = MEMO_ENTRIES - len(self.memo)
        if room > 0:
            self.memo.update((f, ids[f]) for f in new[:room])
        return [ids[f] if known is None else known for f, known in zip(fragments, out)]

    def encode_new(self, new: list[str]) -> dict[str, bytes]:
        ids: dict[str, bytes] = {}
        for at in range(0, len(new), 4096):
            part = new[at:at + 4096]
            for f, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                ids[f] = array("I", e.ids).tobytes()
        return ids


class WordEncoder(Encoder):
    """Words of plain lower-case Latin letters are one pre-token each, so many
    are encoded as one text and told apart by the end-of-word mark of each
    word's last token; other words are encoded one by one."""

    TOGETHER = 1024
    PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+").fullmatch  # U+00F7 is a sign
    STEM = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+"  # each letter's lower case is one of PLAIN
    SIMPLE = STEM + "[!-/:-@\\[-`{-~]*$"

    def __init__(self, text: str):
        super().__init__(text)
        spec = json.loads(text)
        model = spec["model"]
        suffix = model.get("end_of_word_suffix")
        self.ends = np.zeros(1 + max(model["vocab"].values()), dtype=bool)
        if suffix:
            self.ends[[i for t, i in model["vocab"].items() if t.endswith(suffix)]] = True
        # plain words need no normaliser, and spaces part them as any pattern of words does
        self.parted = self.tokenizer
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if [x["type"] for x in steps] == ["Split", "ByteLevel"]:
            steps[0] = {"type": "WhitespaceSplit"}
            self.parted = Encoder(json.dumps(spec | {"normalizer": None})).tokenizer

    def encode_words(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words (large_string) as large_binary.  Words of plain
        letters of either case are taken apart from the ASCII signs behind them,
        which are a pre-token of their own."""
        simple = pc.match_substring_regex(words, self.SIMPLE).to_numpy(zero_copy_only=False)
        if not self.ends.any() or not simple.any():
            return pa.array(self.encode(words.to_pylist()), pa.large_binary())
        low = pc.utf8_lower(words.filter(pa.array(simple)))
        stems, tails = (pc.dictionary_encode(x) for x in (pc.ascii_rtrim(low, punctuation), pc.replace_substring_regex(low, self.STEM, "")))
        known = pa.array([*self.encode_simple(stems.dictionary.to_pylist()), *self.encode(tails.dictionary.to_pylist())], pa.large_binary())
        behind = pc.add(tails.indices.cast(pa.int64()), len(stems.dictionary))
        ids = pc.binary_join_element_wise(known.take(stems.indices), known.take(behind), pa.scalar(b"", pa.large_binary()))
        if len(ids) == len(words):
            return ids
        odd = pa.array(self.encode(words.filter(pa.array(~simple)).to_pylist()), pa.large_binary())
        place = np.where(simple, np.cumsum(simple) - 1, len(ids) + np.cumsum(~simple) - 1)
        return pa.concat_arrays([ids, odd]).take(pa.array(place))

    def encode_simple(self, stems: list[str]) -> list[bytes]:
        """Ids of distinct plain words, by the memo or many as one text."""
        out = list(map(self.memo.get, stems))
        new = [f for f, known in zip(stems, out) if known is None]
        if not new:
            return out
        ids = self.encode_groups(new)
        ids |= Encoder.encode_new(self, [w for w in new if w not in ids])
        room = MEMO_ENTRIES - len(self.memo)
        if room > 0:
            self.memo.update((w, ids[w]) for w in new[:room])
        return [ids[w] if known is None else known for w, known in zip(stems, out)]

    def encode_new(self, new: list[str]) -> dict[str, bytes]:
        """ASCII words are lower-cased beforehand; a full stop or comma after a
        letter is a pre-token of its own."""
        split = []
        for w in new:
            stem = w.lower() if w.isascii() and "<|" not in w else w
            if len(w) > 1 and w[-1] in ".," and w[-2].isalpha() and len(w[-2].lower()) == 1:
                split.append((stem[:-1], w[-1]))
            else:
                split.append((stem, ""))
        stems = self.encode_stems(list({a for a, _ in split if a not in self.memo}))
        tail = {"": b"", **super().encode_new([".", ","])}
        return {w: (self.memo.get(a) or stems.get(a, b"")) + tail[m] for w, (a, m) in zip(new, split, strict=True)}

    def encode_stems(self, stems: list[str]) -> dict[str, bytes]:
        plain = [w for w in stems if self.PLAIN(w)] if self.ends.any() else []
        out = self.encode_groups(plain)
        return out | super().encode_new([w for w in stems if w not in out])

    def encode_groups(self, plain: list[str]) -> dict[str, bytes]:
        """Ids of plain words, of those whose group is told apart by the marks."""
        groups = [plain[at:at + self.TOGETHER] for at in range(0, len(plain), self.TOGETHER)]
        out: dict[str, bytes] = {}
        for words, e in zip(groups, self.parted.encode_batch_fast(
                [" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, "<u4")
            at = [0, *((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()]
            if len(at) == len(words) + 1:
                raw = ids.tobytes()
                out.update((w, raw[a:b]) for w, a, b in zip(words, at[:-1], at[1:], strict=True))
        return out


def encoder(text: str, kind: type[Encoder] = WordEncoder) -> Encoder:
    """The worker's encoder of a tokenizer, made once."""
    key = f"{kind.__name__}:{hashlib.sha256(text.encode()).hexdigest()}"
    if key not in _PER_WORKER:
        _PER_WORKER[key] = kind(text)
    return _PER_WORKER[key]


def word_ids(enc: WordEncoder, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each text and n+1 offsets, for tokenizers that drop white space
    and lower-case (as ``word_bpe_49k.json``): no token spans ASCII white space,
    ASCII words may be lower-cased beforehand, and a full stop or comma after a
    letter is a pre-token of its own."""
    lists = pc.ascii_split_whitespace(texts)
    words = pc.dictionary_encode(pc.list_flatten(lists))
    ids = enc.encode_words(words.dictionary)
    size = np.diff(buffers(ids)[1]) // 4
    taken = pc.take(ids, words.indices)
    raw, _ = buffers(taken)
    per_word = np.append(0, np.cumsum(size[words.indices.to_numpy()]))
    bounds = np.frombuffer(lists.buffers()[1], np.int64 if pa.types.is_large_list(lists.type) else np.int32)
    bounds = bounds[lists.offset:lists.offset + len(lists) + 1].astype(np.int64)
    return raw.view("<u4"), per_word[bounds - bounds[0]]
