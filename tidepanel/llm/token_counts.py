"""Token counts: Arrow functions encode whole batches and return lengths only.

A text is cut before each run of spaces. That is safe for a sentencepiece BPE model in which no piece holds a space
after another character and which leaves white space as it is: merges never cross such a place, so the count of a text
is the sum of the counts of its units. `safe_units` proves this for a model before it is used; other models get
whole texts. Units repeat, so a batch encodes each distinct one once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import documents, text_of

MODEL, LIMIT = "piece_bpe_32k.model", 4096
#: Bytes of text that are encoded at once, and units whose counts a task remembers.
BATCH_BYTES, MEMORY_UNITS = 4 << 20, 400_000
SPACE = "▁"
UNIT = re.compile(" +[^ ]*")


def model_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def safe_units(model) -> bool:
    """True when no piece holds a space after another character, and probes with odd white space add up."""
    if any(re.search(f"[^{SPACE}]{SPACE}", model.id_to_piece(i)) for i in range(model.get_piece_size())):
        return False
    probes = [" a  b ", "a\n\n b\t c", "　a   b", "<s> a </s>  ", "   ", "▁a ▁", "é ́e", "ﬁ Ａ Ⅸ"]
    return all(sum(len(model.encode(u)) if u else 1 for u in units(p)) == len(model.encode(p)) for p in probes)


def units(text: str) -> list[str]:
    """The cuts of a text, each without its first space: the model puts one there. An empty cut is a last lone space."""
    return [u[1:] for u in UNIT.findall(" " + text.replace(SPACE, " "))] if text else []


class Counter:
    """Counts tokens of texts; remembers units within a bound."""

    def __init__(self, path: str):
        self.model, self.known = load(path), {"": 1}
        self.safe = safe_units(self.model)

    def lengths(self, texts: list[str]) -> list[int]:
        if not self.safe:
            return [len(x) for x in self.model.encode(texts, num_threads=1)]
        if len(self.known) > MEMORY_UNITS:
            self.known = {"": 1}
        cut = [units(t) for t in texts]
        new = list({u for us in cut for u in us if u not in self.known})
        self.known.update(zip(new, map(len, self.model.encode(new, num_threads=1))))
        get = self.known.__getitem__
        return [sum(map(get, us)) for us in cut]


def balanced(texts: Iterator[tuple], size: int = BATCH_BYTES) -> Iterator[list[tuple]]:
    """Batches of at most `size` bytes, or of one text that is longer."""
    batch, held = [], 0
    for row in texts:
        if batch and held + row[1] > size:
            yield batch
            batch, held = [], 0
        batch.append(row)
        held += row[1]
    if batch:
        yield batch


def pieces_of(text: str, size: int) -> Iterator[str]:
    """A long text in stretches of about `size` characters, cut before a space; the space goes, as `units` drops it."""
    at = 0
    while len(text) - at > size:
        cut = text.find(" ", at + size)
        while 0 < cut and text[cut - 1] == " ":
            cut = text.find(" ", cut + 1)
        if cut < 0 or cut == len(text) - 1:
            break
        yield text[at:cut]
        at = cut + 1
    yield text[at:]


def token_counts(docs: DataFrame, model: str = MODEL, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each row of docs (doc_id, text; more columns are ignored).

    Null and empty texts have 0 tokens. Every row is counted, repeated ones too. Special strings inside a text are
    ordinary text to the library, as is its default. An empty table gives an empty result.
    """
    path, kind = model_path(model), docs.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for batch in batches:
            ids, sizes, totals = batch.column("doc_id"), [], []
            texts = batch.column("text")

            def stretches():
                for i in range(len(texts)):
                    text = texts[i].as_py()
                    sizes.append(len(text.encode()))
                    totals.append(0)
                    if not counter.safe or sizes[i] <= BATCH_BYTES:
                        yield i, sizes[i], text
                        continue
                    for part in pieces_of(text.replace(SPACE, " "), BATCH_BYTES // 4):
                        yield i, len(part), part

            for group in balanced(stretches()):
                for (i, _, _), n in zip(group, counter.lengths([t for _, _, t in group])):
                    totals[i] += n
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(totals, pa.int64()), pa.array([t > limit for t in totals], pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op5(spark, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))
