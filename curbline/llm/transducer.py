"""BPE encoding as a streaming transducer with bounded lookahead, and the way back.

The tokenizer file gives merges with an end-of-word suffix. A pair is merged in the order
of the merge list, so what follows a symbol can change its token only through a chain of
merges of ever higher priority. ``Merges.lookahead`` is the longest such chain, computed
from the list once. A token that ends that far before the last symbol read is final, so it
is emitted and forgotten: a word of any length is encoded in constant memory.

Decoding feeds the bytes of each id to a state machine that holds at most the three
pending bytes of one unfinished character.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial
from itertools import chain, islice, pairwise

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import batch, map_arrow
from curbline.llm.vocabularies import vocabulary

WORD_BPE = "word_bpe_49k.json"
# Words up to this length are merged directly and remembered.
SHORT = 48
# Runs beyond so many characters come in parts of so many ids.
LONG, PART_IDS = 1 << 16, 4096
# Entries of each half of a worker's memory of words.
MEMORY = 250_000
# White space of the tokenizer's normalizer; Python's split also takes U+001C to U+001F.
SPACE = regex.compile("[\t-\r \x85\xa0  -     　]+")
ODD = regex.compile("[\x1c-\x1fΣ]|<\\|")


def byte_alphabet() -> list[str]:
    """The character by which byte-level vocabularies write each byte.

    Printable Latin-1 bytes stand for themselves, the others for characters from U+0100 on.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = (chr(256 + i) for i in range(256))
    return [chr(b) if b in shown else next(hidden) for b in range(256)]


class Merges:
    """A merge list with its vocabulary and its sufficient lookahead, in symbols."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]], suffix: str = ""):
        self.vocab = vocab
        self.suffix = suffix
        self.rank = {tuple(pair): i for i, pair in enumerate(merges)}
        self.symbol = list(vocab)
        self.number = {s: n for n, s in enumerate(self.symbol)}
        number = self.number
        self.pair_rank = {number[a] << 20 | number[b]: r for (a, b), r in self.rank.items()}
        self.result = [number[a + b] for a, b in self.rank]
        self.longest = 1
        self.lookahead = self._sufficient_lookahead()

    def _sufficient_lookahead(self) -> int:
        """The farthest a token's end can be from text that still changes it.

        A merge (u, v) is undone from the right when v, or the part of v that ends it, is
        taken first by a merge of higher priority whose left side it is. So a merge sees the
        length of v, plus the most that any such earlier merge sees. In order of priority,
        the earlier merges are done when they are needed.
        """
        length: dict[str, int] = {}
        right_part: dict[str, str] = {}
        sees: dict[str, int] = {}  # by left side: the most that any merge so far sees
        most = 0

        def size(token: str) -> int:
            return length.setdefault(token, len(token.removesuffix(self.suffix)) or 1)

        for left, right in self.rank:
            reach, part = 0, right
            while part is not None:
                reach = max(reach, sees.get(part, 0))
                part = right_part.get(part)
            far = size(right) + reach
            sees[left] = max(sees.get(left, 0), far)
            most = max(most, far)
            right_part.setdefault(left + right, right)
            self.longest = max(self.longest, size(left + right))
        return most + 2 * self.longest

    def merge(self, symbols: list[str]) -> list[str]:
        """The tokens of all the symbols."""
        return self._merge_few(symbols) if len(symbols) <= SHORT else self._merge_many(symbols)

    def _merge_few(self, symbols: list[str]) -> list[str]:
        """The same on numbers: each symbol of the vocabulary has one, each pair a key."""
        number, known = self.number, self.pair_rank.get
        held = [number[s] for s in symbols]
        none = len(self.rank)
        ranks = [known(a << 20 | b, none) for a, b in pairwise(held)]
        while ranks and (best := min(ranks)) < none:
            i = ranks.index(best)
            held[i] = self.result[best]
            del held[i + 1], ranks[i]
            if i:
                ranks[i - 1] = known(held[i - 1] << 20 | held[i], none)
            if i < len(ranks):
                ranks[i] = known(held[i] << 20 | held[i + 1], none)
        return [self.symbol[n] for n in held]

    def _merge_many(self, symbols: list[str]) -> list[str]:
        n, rank = len(symbols), self.rank.get
        parts: list[str | None] = list(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or rank((parts[i], parts[j])) != r:
                continue
            parts[i], parts[j] = parts[i] + parts[j], None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank((parts[i], parts[k]))) is not None:
                    heapq.heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := rank((parts[h], parts[i]))) is not None:
                heapq.heappush(heap, (r, h))
        return [p for p in parts if p is not None]

    def stream(self, symbols: Iterable[str]) -> Iterator[str]:
        """The tokens of a stream of symbols, each as soon as nothing can change it."""
        window = 4 * self.lookahead
        held: list[str] = []
        sizes = len
        for symbol in symbols:
            held.append(symbol)
            if sizes(held) < window:
                continue
            at = 0
            for token in self._merge_many(held):
                end = at + self.units(token)
                if end > window - self.lookahead:
                    break
                yield token
                at = end
            held = held[at:]
        yield from self.merge(held)

    def units(self, token: str) -> int:
        """How many symbols a token is made of."""
        return len(token.removesuffix(self.suffix)) if self.suffix else len(token)


class Memory:
    """A bounded memory of results. What was used since the last turn survives the next."""

    def __init__(self, size: int = MEMORY):
        self.size, self.new, self.old = size, {}, {}

    def get(self, key):
        found = self.new.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.new) >= self.size:
            self.old, self.new = self.new, {}
        self.new[key] = value


class ByteToText:
    """Bytes in, characters out. The state is the pending bytes of an unfinished character;
    what can't be finished comes out as U+FFFD, like Python's ``errors="replace"``."""

    def __init__(self) -> None:
        self.pending = b""

    def feed(self, data: bytes, last: bool = False) -> str:
        if not self.pending and data.isascii():
            return data.decode()
        data = self.pending + data
        keep = 0 if last else self._unfinished(data)
        self.pending = data[len(data) - keep :]
        return data[: len(data) - keep].decode("utf-8", "replace")

    @staticmethod
    def _unfinished(data: bytes) -> int:
        """Length of the tail that further bytes could complete."""
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if lead >= 0xC0:
                need = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                return back if back < need and lead < 0xF8 else 0
            if lead < 0x80:
                return 0
        return 0


class WordTokenizer:
    """The tokenizer of a file: NFC, white space dropped, lower case, words, merges.

    Special tokens in a text are found first, as the library does by default.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"])
        self.suffix = model["end_of_word_suffix"] or ""
        self.merges = Merges(model["vocab"], pairs, self.suffix)
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.find_special = regex.compile("|".join(map(regex.escape, self.special)) or "(?!)")
        splits = data["pre_tokenizer"]["pretokenizers"]
        self.words = regex.compile(next(s["pattern"]["Regex"] for s in splits if "pattern" in s))
        self.alphabet = byte_alphabet()
        self.byte_of = {c: b for b, c in enumerate(self.alphabet)}
        named = [*model["vocab"].items(), *self.special.items()]
        self.token = {i: t.encode() for t, i in named}
        self.runs, self.few = Memory(), Memory()

    def word_ids(self, word: str) -> Iterable[int]:
        """Ids of one pre-token. Short words are remembered, long ones are streamed."""
        found = self.few.get(word)
        if found is not None:
            return found
        data, alphabet, vocab = word.encode(), self.alphabet, self.merges.vocab
        if len(data) > SHORT:
            symbols = chain(map(alphabet.__getitem__, data[:-1]), [alphabet[data[-1]] + self.suffix])
            return map(vocab.__getitem__, self.merges.stream(symbols))
        symbols = list(word) if word.isalpha() and word.isascii() else [alphabet[b] for b in data]
        symbols[-1] += self.suffix
        found = [vocab[t] for t in self.merges.merge(symbols)]
        self.few.put(word, found)
        return found

    def run_ids(self, run: str) -> Iterator[int]:
        """Ids of a run of characters without white space, as they become stable."""
        # Lower case is taken by character, so a final sigma is an ordinary one.
        if run.isascii():
            run = run.lower()
        else:
            run = unicodedata.normalize("NFC", run).replace("Σ", "σ").lower()
        if run.isascii() and run.isalpha():
            return iter(self.word_ids(run))
        found = self.words.findall(run) if len(run) <= LONG else (m[0] for m in self.words.finditer(run))
        return chain.from_iterable(map(self.word_ids, found))

    def recall(self, run: str) -> tuple[int, str, str]:
        """Number of ids, the ids and their tokens as text, of a run without white space."""
        found = self.runs.new.get(run) or self.runs.get(run)
        if found is None:
            ids = list(self.run_ids(run))
            found = len(ids), " ".join(map(str, ids)), self.decode(ids)
            if len(run) <= SHORT:
                self.runs.put(run, found)
        return found

    def known(self, runs: Iterable[str]) -> Iterator[tuple[int, str, str]]:
        """``recall`` of each run; a very long one comes in parts, and only one is held."""
        for run in runs:
            if len(run) <= LONG:
                yield self.recall(run)
                continue
            ids = self.run_ids(run)
            while part := list(islice(ids, PART_IDS)):
                yield len(part), " ".join(map(str, part)), self.decode(part)

    def pieces(self, text: str) -> Iterator[tuple[int, str, str]]:
        """Number of ids, ids and tokens of each run and each special token, in order."""
        of = self.known if len(text) > LONG else partial(map, self.recall)
        if not ODD.search(text):
            yield from of(text.split())
            return
        at = 0
        for found in self.find_special.finditer(text):
            yield from of(filter(None, SPACE.split(text[at : found.start()])))
            yield 1, str(self.special[found[0]]), found[0]
            at = found.end()
        yield from of(filter(None, SPACE.split(text[at:])))

    def encode(self, text: str) -> list[int]:
        return [int(i) for _, ids, _ in self.pieces(text) for i in ids.split(" ")]

    def decode(self, ids: Iterable[int]) -> str:
        """The library's text of the ids: this vocabulary names no decoder, so the tokens as
        the vocabulary writes them, with a space between. Unknown ids are left out."""
        machine, token, out, gap = ByteToText(), self.token, [], b""
        for i in ids:
            if i in token:
                out.append(machine.feed(gap + token[i]))
                gap = b" "
        out.append(machine.feed(b"", last=True))
        return "".join(out)

    def decode_words(self, ids: Iterable[int]) -> str:
        """Plain text: bytes put together again, a space after each word."""
        machine, out = ByteToText(), []
        for i in ids:
            token = self.token.get(i, b"").decode()
            if token in self.special:
                out.append(machine.feed(token.encode()))
                continue
            stem = token.removesuffix(self.suffix) if self.suffix else token
            data = bytes(self.byte_of[c] for c in stem)
            out.append(machine.feed(data + b" " * (stem != token)))
        out.append(machine.feed(b"", last=True))
        return "".join(out)


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    """One per worker process; its memory serves all tasks."""
    return WordTokenizer(path)


def transcode(docs: DataFrame, name: str = WORD_BPE, folder: str | None = None) -> DataFrame:
    """Encode every whole text and decode it again: doc_id, n_tokens, ids (decimal, joined by
    one space) and decoded.

    Map-only. Null and empty texts have no ids and decode to the empty text; repeated rows
    give repeated results; an empty table gives none. Columns besides doc_id and text are
    not read.
    """

    def run(batches):
        coder = tokenizer(vocabulary(name, folder))
        for rows in batches:
            counts, ids, texts = [], [], []
            for text in rows.column("text").to_pylist():
                found = list(coder.pieces(text or ""))
                counts.append(sum([f[0] for f in found]))
                ids.append(" ".join([f[1] for f in found]))
                texts.append(" ".join([f[2] for f in found]))
            yield batch(
                doc_id=rows.column("doc_id"),
                n_tokens=pa.array(counts, pa.int64()),
                ids=pa.array(ids, pa.string()),
                decoded=pa.array(texts, pa.string()),
            )

    schema = "doc_id bigint, n_tokens bigint, ids string, decoded string"
    return map_arrow(docs.select(F.col("doc_id").cast("bigint"), "text"), run, schema)
