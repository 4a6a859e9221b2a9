"""BPE encoding and decoding with forced boundaries.

A merge can only join two neighbouring symbols if some vocabulary token holds them
side by side. So every neighbouring pair that no token holds is a certain cut: the
fragments between such cuts are encoded independently and their ids concatenated,
with the same result as merging over the whole word. Words are memoized, fragments
too, within bounded tables.

Defined results. Null text: as empty, no ids. Texts of any length are cut at white
space first, so no step holds more than one word's symbols beside the ids. Repeated
rows are encoded alike; other columns pass through.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsift.llm.common import free_name, small_batches

END = "</w>"
#: Chunks, words and fragments kept by one task, each.
MEMO = 400_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Visible Latin-1 characters stand for themselves, the others follow from 256 on.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, spare = {b: chr(b) for b in own}, 256
    for b in range(256):
        if b not in table:
            table[b] = chr(spare)
            spare += 1
    return [table[b] for b in range(256)]


class Memo(dict):
    """Results by text in two generations, so that what is met often outlives a full table."""

    def __init__(self, size: int):
        self.half, self.old = max(1, size // 2), {}

    def older(self, key: str):
        """The result of the older generation, moved to the younger; None if there is none."""
        found = self.old.get(key)
        return found and self.keep(key, found)

    def keep(self, key: str, value):
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class WordBpe:
    """Encoder for a tokenizer file of the word-end kind (NFC, lower case, white space dropped)."""

    def __init__(self, path: str, memo: int = MEMO):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (self.ids | self.special).items()}
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(pattern)
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.bytes = byte_symbols()
        self.inside = {x + y for t in self.ids for s in [self.symbols_of(t)] for x, y in zip(s, s[1:], strict=False)}
        self.chunks, self.words, self.fragments = Memo(memo), Memo(memo), Memo(memo)
        self.path = path
        self.library = None

    @staticmethod
    def symbols_of(token: str) -> list[str]:
        """Single symbols of a token; the last carries the word end if the token has it."""
        if token.endswith(END) and token != END:
            body = token[: -len(END)]
            return [*body[:-1], body[-1] + END]
        return list(token)

    def merge(self, symbols: list[str]) -> list[str]:
        """Merge the neighbours of lowest rank, the leftmost first, until no pair has a rank."""
        rank, none = self.ranks.get, len(self.ranks)
        parts = list(symbols)
        costs = [rank(p, none) for p in zip(parts, parts[1:], strict=False)]
        while costs and (best := min(costs)) < none:
            i = costs.index(best)
            parts[i] += parts.pop(i + 1)
            del costs[i]
            if i:
                costs[i - 1] = rank((parts[i - 1], parts[i]), none)
            if i < len(costs):
                costs[i] = rank((parts[i], parts[i + 1]), none)
        return parts

    def fragment(self, symbols: list[str]) -> tuple[str, str]:
        key = "".join(symbols)
        found = self.fragments.get(key) or self.fragments.older(key)
        return found or self.fragments.keep(key, self._joined(self.merge(symbols)))

    def _joined(self, tokens: list[str]) -> tuple[str, str]:
        return " ".join([str(self.ids[t]) for t in tokens]), " ".join(tokens)

    def cut(self, symbols: list[str]) -> list[list[str]]:
        """The fragments between certain cuts."""
        inside, out, start = self.inside, [], 0
        for i, pair in enumerate(map("".join, zip(symbols, symbols[1:], strict=False)), 1):
            if pair not in inside:
                out.append(symbols[start:i])
                start = i
        out.append(symbols[start:])
        return out

    def word(self, word: str) -> tuple[str, str]:
        """Ids and tokens of one pre-token, each joined by one blank."""
        found = self.words.get(word) or self.words.older(word)
        if not found:
            symbols = list(word) if word.isascii() and word.isalnum() else [self.bytes[b] for b in word.encode("utf-8")]
            symbols[-1] += END
            parts = [self.fragment(x) for x in self.cut(symbols)]
            found = parts[0] if len(parts) == 1 else (" ".join([p[0] for p in parts]), " ".join([p[1] for p in parts]))
            self.words.keep(word, found)
        return found

    def pre_tokens(self, chunk: str) -> list[str]:
        """The normalized pre-tokens of a piece of text without white space."""
        if _UNCOMMON.search(chunk):
            # what is a letter there depends on the Unicode version, so the library says
            if self.library is None:
                from tokenizers import Regex, Tokenizer, pre_tokenizers

                self.library = Tokenizer.from_file(self.path).normalizer, pre_tokenizers.Split(Regex(self.pattern.pattern), "removed", invert=True)
            normalizer, split = self.library
            return [w for w, _ in split.pre_tokenize_str(normalizer.normalize_str(chunk))]
        # capital sigma goes letter by letter, whatever follows it
        return self.pattern.findall(unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower())

    def chunk(self, chunk: str) -> tuple[str, str]:
        """Ids and tokens, each joined by one blank, of a piece of text without white space."""
        found = self.chunks.older(chunk)
        if found:
            return found
        parts = [self.word(w) for w in self.pre_tokens(chunk)]
        found = parts[0] if len(parts) == 1 else (" ".join([p[0] for p in parts]), " ".join([p[1] for p in parts]))
        return self.chunks.keep(chunk, found)

    def pieces(self, text: str) -> Iterator[tuple[str, str]]:
        """(ids, tokens) of the parts of a text, in order; some may be empty."""
        known, chunk = self.chunks.get, self.chunk
        parts = self.cut_special.split(text) if "<|" in text else (text,)
        for part in parts:
            if part in self.special:
                yield str(self.special[part]), part
            else:
                for c in split_spaces(part):
                    yield known(c) or chunk(c)

    def encode(self, text: str) -> list[int]:
        return [int(i) for ids, _ in self.pieces(text) for i in ids.split()]

    def decode(self, ids: list[int]) -> str:
        """The tokens joined by blanks, as a tokenizer file without a decoder defines it."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)


#: Letters outside the blocks up to Cyrillic.
_UNCOMMON = regex.compile("[^\\x00-\u052f]")
#: Separators that str.split takes for white space and the tokenizer doesn't.
_NOT_SPACE = regex.compile("[\x1c-\x1f]")
_SPACE = regex.compile(r"[^\S\x1c-\x1f]+")


def split_spaces(text: str) -> list[str]:
    """The parts of a text between white space, as the tokenizer's normalizer sees it."""
    if _NOT_SPACE.search(text):
        return [x for x in _SPACE.split(text) if x]
    return text.split()


def encode_decode(docs: DataFrame, path: str, memo: int = MEMO) -> DataFrame:
    """Add ids (array<int>) and decoded (string) to every row that has a ``text``.

    Where the table has columns of these names, the new ones get underscores in front.
    """
    small_batches(docs.sparkSession)
    names = [free_name(docs.columns, n) for n in ("ids", "decoded")]
    empty = [F.lit(None).cast(t).alias(n) for t, n in zip(("array<int>", "string"), names, strict=True)]
    plain = docs.select("*", *empty)

    def run(batches):
        bpe = WordBpe(path, memo)  # its memory goes with the task
        for b in batches:
            ids = [bpe.encode(t.as_py() or "") for t in b.column(b.schema.get_field_index("text"))]
            decoded = [bpe.decode(x) for x in ids]
            columns = [*b.columns[:-2], pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)

    return plain.mapInArrow(run, plain.schema)


def encode_digests(docs: DataFrame, path: str, memo: int = MEMO) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document, without shuffling."""
    small_batches(docs.sparkSession)

    def run(batches):
        bpe = WordBpe(path, memo)  # its memory goes with the task
        for b in batches:
            n, ids_hex, text_hex = [], [], []
            for t in b.column("text"):
                # the first pass gives the ids; they alone are decoded
                found = [p for p in bpe.pieces(t.as_py() or "") if p[0]]
                ids = " ".join([p[0] for p in found])
                n.append(ids.count(" ") + 1 if ids else 0)
                ids_hex.append(hashlib.sha256(ids.encode()).hexdigest())
                text_hex.append(hashlib.sha256(" ".join([p[1] for p in found]).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_hex), pa.array(text_hex)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


def default_path() -> str:
    """Path of the word-end vocabulary file; the files stay outside the repository."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode_table(spark: SparkSession, docs: DataFrame, path: str | None = None) -> DataFrame:
    return encode_digests(docs, path or default_path())
