"""BPE encoding and decoding by a trie of distinct words.

The encoder reads a word-level BPE vocabulary (the ``tokenizers`` JSON format with an
end-of-word suffix). Two facts make the traversal work, both for merge lists in which a
merged symbol ranks after its parts:

* a sequence of tokens is the encoding of its text exactly if every neighbouring pair is
  the encoding of the pair's text, so an encoding is found from the last token alone: the
  last token of a prefix is the one vocabulary entry ending there that is compatible with
  the last token of the shorter prefix before it;
* the last token of a prefix does not depend on what follows, so words that share a prefix
  share its states.

Distinct words go into a trie; one depth-first walk carries the last-token states down the
path and reads off every word's tokens. The state of a shared prefix is computed once. The
trie needs no nodes: words in order are its leaves in depth-first order, and the walk goes
back to where a word leaves the one before it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from .shared import by_text

# Bytes of the words remembered in a task, and what an entry takes besides its texts. Beyond
# it the memory starts anew; words of the memory before that are still looked up.
REMEMBERED, ENTRY = 40 << 20, 350
# Remembered steps and pairs of tokens.
STEPS = 150_000
# Characters of texts that are learnt together; a longer text is alone.
LEARNT = 4 << 20

# The printable stand-ins of byte-level vocabularies. Printable Latin-1
# bytes stand for themselves, the other bytes for code points from 256 on.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = {b: chr(b) for b in PRINTABLE} | {
    b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(PRINTABLE))
}
BYTE_TABLE = {b: c for b, c in BYTE_CHARS.items()}
# How the vocabulary's configuration cuts words, for characters up to Latin Extended-A:
# runs of letters, single digits, runs of anything else but white space.
LATIN_END = "\u0180"
LATIN = [chr(i) for i in range(ord(LATIN_END))]
LETTERS = "".join(c for c in LATIN if c.isalpha())
DIGITS = "".join(c for c in LATIN if c.isnumeric())
PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^ \t\n\v\f\r\x85\xa0{LETTERS}{DIGITS}]+"
# White space for str.split() but not for the vocabulary.
ODD_SPACE = "\x1c\x1d\x1e\x1f"


class TrieEncoder:
    """Encodes sets of words over one vocabulary.

    ``vocab`` maps token strings to ids, ``merges`` lists pairs of token strings in order
    of rank, ``suffix`` ends the last symbol of a word.
    """

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        self.vocab, self.suffix = vocab, suffix
        self.rank = {(a, b): i for i, (a, b) in enumerate(merges)}
        self.parts = {a + b: (a, b) for a, b in merges}
        # Tokens that merging can reach: whole symbols, and results of merges.
        alphabet = {*BYTE_CHARS.values()}
        alphabet |= {c + suffix for c in alphabet}
        self.tokens = {t for t in vocab if t in alphabet or t in self.parts}
        self.inner = {t for t in self.tokens if not t.endswith(suffix)}
        bare = {t.removesuffix(suffix) for t in self.tokens}
        self.begins = {t[:i] for t in bare for i in range(1, len(t) + 1)}
        self._steps: dict[str, str] = {}
        self._inner: dict[str, list[tuple[str, int]]] = {}
        self._edges: dict[tuple[str, bool], list[tuple[str, float]]] = {}
        self._pairs: dict[tuple[str, str], bool] = {}

    def forget(self) -> None:
        """Start the memory of steps and pairs anew if it has grown."""
        if len(self._pairs) + len(self._steps) > STEPS:
            self._pairs.clear()
            self._steps.clear()
            self._inner.clear()

    def edge(self, token: str, right: bool) -> list[tuple[str, float]]:
        """The symbols that stand at one end of a token while it is being merged, each with
        the rank of the merge that takes it away."""
        key = (token, right)
        if key not in self._edges:
            path, gone = [], float("inf")
            while True:
                path.append((token, gone))
                pair = self.parts.get(token)
                if pair is None:
                    break
                gone, token = self.rank[pair], pair[right]
            self._edges[key] = path
        return self._edges[key]

    def compatible(self, left: str, right: str) -> bool:
        """Whether the two tokens' joint text is encoded as these two tokens.

        It is not if some merge across the border comes up while both its symbols stand
        there. Of equal merges the leftmost goes first.
        """
        key = (left, right)
        known = self._pairs.get(key)
        if known is None:
            rank, known = self.rank, True
            ends = self.edge(right, False)
            for a, gone_a in self.edge(left, True):
                for b, gone_b in ends:
                    at = rank.get((a, b))
                    if at is not None and at < gone_a and at <= gone_b:
                        known = False
                        break
                if not known:
                    break
            self._pairs[key] = known
        return known

    def follow(self, state: str, char: str) -> str:
        """The longest ending of ``state + char`` that begins some token."""
        key = state + char
        known = self._steps.get(key)
        if known is None:
            known = key
            while known and known not in self.begins:
                known = known[1:]
            self._steps[key] = known
            self._inner[known] = [(t, len(t)) for i in range(len(known)) if (t := known[i:]) in self.inner]
        return known

    def encode(self, words: Iterable[str]) -> Iterator[tuple[str, list[str]]]:
        """Every word (in byte characters, not empty) with its tokens."""
        before, states, path = "", [], [""]
        steps, inner, pairs = self._steps, self._inner, self._pairs
        for word in sorted(words):
            shared = 0
            for a, b in zip(word, before):
                if a != b:
                    break
                shared += 1
            del states[shared:], path[shared + 1 :]
            state = path[-1]
            for depth in range(shared, len(word)):
                char = word[depth]
                longer = steps.get(state + char)
                if longer is None:
                    longer = self.follow(state, char)
                # The last token of this prefix: the one compatible with the state before it.
                for token, size in inner[longer]:
                    start = depth - size
                    if start < 0:
                        break
                    fits = pairs.get((states[start], token))
                    if fits or fits is None and self.compatible(states[start], token):
                        break
                states.append(token)
                path.append(longer)
                state = longer
            yield word, self.read(word, state, states)
            before = word

    def ending(self, word: str, state: str, states: list[str]) -> str:
        """The last token of a whole word, which carries the suffix."""
        for i in range(len(state)):
            token = state[i:] + self.suffix
            if token in self.tokens:
                start = len(word) - len(state) + i
                if start == 0 or self.compatible(states[start - 1], token):
                    return token
        raise ValueError(f"no token ends {word!r}")

    def read(self, word: str, state: str, states: list[str]) -> list[str]:
        """A word's tokens, from its end back through the states."""
        token = self.ending(word, state, states)
        found, at = [token], len(word) - len(token) + len(self.suffix)
        while at:
            token = states[at - 1]
            found.append(token)
            at -= len(token)
        return found[::-1]


class TextCoder:
    """Whole texts to ids and back, remembering the pieces seen."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.encoder = TrieEncoder(model["vocab"], merges, model["end_of_word_suffix"])
        self.vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.pieces = re.compile(PIECES).findall
        library = Tokenizer.from_str(json.dumps(spec | {"model": {"type": "BPE", "vocab": {}, "merges": []}, "added_tokens": []}))
        self.normal, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.decimals = {t: str(i) for t, i in self.vocab.items()}
        self.names = {str(i): t for t, i in (self.vocab | self.special).items()}
        # Ids of a word as decimals, and the text they decode to.
        self.known: dict[str, tuple[str, str]] = {}
        self.older: dict[str, tuple[str, str]] = {}
        self.size = 0

    def words(self, chunk: str) -> list[str]:
        """Byte-character words of a chunk. Latin letters are composed already and cut here;
        for anything else the library cuts, whose tables are of one Unicode version."""
        if max(chunk) < LATIN_END and "\u0130" not in chunk:
            found = self.pieces(chunk.lower())
            return [w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(BYTE_TABLE) for w in found]
        return [w for w, _ in self.split(self.normal(chunk))]

    def chunks(self, text: str) -> list[str]:
        """A text without special tokens, cut at white space."""
        if any(c in text for c in ODD_SPACE):
            return [c for c in regex.split(r"\p{White_Space}+", text) if c]
        return text.split()

    def parts(self, text: str) -> list[str]:
        """The text between special tokens, at even places, and those tokens."""
        return self.cut.split(text) if any(t in text for t in self.special) else [text]

    def learn(self, texts: list[str]) -> None:
        """Encode the words of these texts that are not known yet, all in one trie."""
        if self.size > REMEMBERED:
            self.known, self.older, self.size = {}, self.known, 0
            self.encoder.forget()
        known, older, decimals = self.known, self.older, self.decimals
        missing = {c for text in texts for part in self.parts(text)[::2] for c in self.chunks(part) if c not in known}
        cut = {}
        for chunk in missing:
            entry = older.get(chunk)
            if entry is None:
                cut[chunk] = self.words(chunk)
            else:
                known[chunk] = entry
        coded = {
            word: " ".join([decimals[t] for t in tokens])
            for word, tokens in self.encoder.encode({w for words in cut.values() for w in words})
        }
        for chunk, words in cut.items():
            ids = coded[words[0]] if len(words) == 1 else " ".join(map(coded.__getitem__, words))
            known[chunk] = ids, self.decode(ids)
        self.size += sum(ENTRY + 6 * len(chunk) for chunk in missing)

    def encode(self, text: str) -> list[tuple[str, str]]:
        """For each word of a text that was learnt its ids, as decimals joined by spaces, and
        what they decode to."""
        found = []
        for i, part in enumerate(self.parts(text)):
            if i % 2:
                found.append((str(self.special[part]), part))
            else:
                found.extend(map(self.known.__getitem__, self.chunks(part)))
        return found

    def decode(self, ids: str) -> str:
        """Token strings joined by spaces: the vocabulary names no decoder."""
        return " ".join(map(self.names.__getitem__, ids.split(" ")))

    def coded(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        """Ids and decoded text of whole texts."""
        group, size = [], 0
        for i, text in enumerate(texts):
            group.append(text)
            size += len(text)
            if size > LEARNT or i == len(texts) - 1:
                self.learn(group)
                for one in group:
                    words = self.encode(one)
                    yield " ".join([ids for ids, _ in words]), " ".join([decoded for _, decoded in words])
                group, size = [], 0


def encode_texts(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode every whole text: one row per input row.

    Returns ``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``, ``ids``
    (array of int). A null or empty text has no ids and the hashes of the empty string.
    Repeated rows give repeated results, an empty table none, other columns are ignored.
    ``path`` is the vocabulary's file on every machine.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = TextCoder(path)
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for ids, decoded in coder.coded([text or "" for text in batch.column(1).to_pylist()]):
                out[0].append(ids.count(" ") + 1 if ids else 0)
                out[1].append(sha256(ids.encode()).hexdigest())
                out[2].append(sha256(decoded.encode()).hexdigest())
                out[3].append(ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1]), pa.array(out[2]), pa.array(out[3])],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "id_text"],
            )

    kind = df.schema[doc_id].dataType.simpleString()
    coded = by_text(
        df,
        f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, id_text string",
        rows, F.col(doc_id), F.col(text).cast("string"),
    )
    ids = F.when(F.col("id_text") == "", F.array().cast("array<int>")).otherwise(
        F.split("id_text", " ").cast("array<int>")
    )
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", ids.alias("ids"))
