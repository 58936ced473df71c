"""Token counts: count pieces once per distinct pre-token and add them up per document.

A byte-level BPE first cuts a text into pre-tokens by a fixed pattern and then merges inside each, so the
number of tokens of a text is the sum over its pre-tokens. The distinct pre-tokens of all texts are
encoded once. Each document's pre-token frequencies are joined to them and summed; ids are never built.
Pre-tokens that make up at least 1 / ``common`` of all occurrences (so ``common`` at most) are given to the
tasks as a table; the others go through a shuffled join. Both ways give the same counts.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelkit.llm.common import chunks, stored

# The published pre-token pattern of the byte-level BPE, with white space as Unicode defines it.
SPACES = r"\x09-\x0D\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACES}\p{{L}}\p{{N}}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)
# Distinct pre-tokens a task holds before it passes their counts on.
HELD = 200_000


def check_supported(tokenizer_json: str) -> None:
    """Raise ValueError unless a tokenizer file cuts texts as this module does: a byte-level BPE with the published pattern, without
    normalizer, and with special strings that are taken as they stand."""
    config = json.loads(tokenizer_json)
    cut, model = config.get("pre_tokenizer") or {}, config.get("model") or {}
    asked = {
        "a BPE model": model.get("type", "BPE") == "BPE",
        "no dropout, prefix, suffix or whole words taken without merges": not any(
            model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback", "unk_token")
        ),
        "no normalizer": config.get("normalizer") is None,
        "byte-level pre-tokens by its own pattern": cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space", True),
        "no truncation or padding": config.get("truncation") is None and config.get("padding") is None,
        "special strings taken as they stand": not any(
            t.get(k) for t in config.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip", "normalized")
        ),
    }
    lacking = [name for name, met in asked.items() if not met]
    if lacking:
        raise ValueError(f"token counts of this tokenizer are not supported; needed: {'; '.join(lacking)}")


def special_strings(tokenizer_json: str) -> list[str]:
    """Strings that the tokenizer takes as one token wherever they stand in a text."""
    added = json.loads(tokenizer_json).get("added_tokens", [])
    return sorted((t["content"] for t in added), key=len, reverse=True)


def cutter(specials: list[str]):
    """Two functions: a text to its units and the number of special strings in it, and a unit to its pre-tokens.

    A single space between two words always begins a pre-token, so a text may be cut there first. The units
    this gives repeat far more than texts do, and each distinct one is matched against the pattern once.
    """
    find = regex.compile(PATTERN).findall
    single = re.compile(r"(?<=\S) (?=\S)").split
    rare = re.compile(r"[^\S \n]").search
    split = regex.compile("|".join(map(regex.escape, specials))).split if specials else None

    def units(text: str) -> list[str]:
        if "  " in text or " \n" in text or "\n " in text or rare(text):
            return single(text)
        return text.split(" ")

    def cut(text: str) -> tuple[list[str], list[str], int]:
        """Units that follow a space, units that do not, special strings."""
        parts = split(text) if split and any(s in text for s in specials) else [text]
        later, firsts = [], []
        for part in parts:
            found = units(part)
            firsts.append(found[0])
            later += found[1:]
        return later, firsts, len(parts) - 1

    return cut, find


def piece_counts(pieces: DataFrame, tokenizer_json: str) -> DataFrame:
    """Add ``tokens``, the number of BPE pieces, to distinct pre-tokens in column ``piece``."""
    config = json.loads(tokenizer_json)
    config["added_tokens"] = []
    plain = json.dumps(config)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = Tokenizer.from_str(plain)
        for batch in chunks(batches, "piece", 1 << 18):
            made = model.encode_batch_fast(batch.column("piece").to_pylist(), add_special_tokens=False)
            tokens = pa.array([len(m) for m in made], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("piece"), batch.column("n"), tokens], ["piece", "n", "tokens"])

    return pieces.select("piece", "n").mapInArrow(encode, "piece string, n long, tokens long")


def count_tokens(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", common: int = 500_000) -> DataFrame:
    """(key, n_bytes, n_tokens) for every row of ``docs``, in its ``text`` column.

    Null and empty texts have 0 bytes and tokens; the key may be null or repeated, each row is counted by
    itself; other columns are ignored; an empty table gives an empty result. The tokenizer file is shipped
    to the executors as text.
    """
    with open(tokenizer_path) as file:
        tokenizer_json = file.read()
    check_supported(tokenizer_json)
    specials = special_strings(tokenizer_json)
    texts = docs.select(F.col(key).alias("key"), "text")

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, find = cutter(specials)
        later, firsts = Counter(), Counter()

        def rows() -> pa.RecordBatch:
            seen: dict[str, int] = {}
            for lead, held in ((" ", later), ("", firsts)):
                for unit, n in held.items():
                    for piece in find(lead + unit):
                        seen[piece] = seen.get(piece, 0) + n
                held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["piece", "n"]
            )

        for batch in chunks(batches):
            near: list[str] = []
            for text in batch.column("text").to_pylist():
                if text:
                    units, begins, _ = cut(text)
                    near += units
                    firsts.update(begins)
            later.update(Counter(near))
            if len(later) + len(firsts) >= HELD:
                yield rows()
        yield rows()

    pieces = texts.select("text").mapInArrow(distinct, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    known = stored(piece_counts(pieces, tokenizer_json), "pieces")
    total = known.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    table = {r["piece"]: r["tokens"] for r in known.where(F.col("n") * common >= total).select("piece", "tokens").collect()}

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, find = cutter(specials)
        memo: dict[str, tuple[int, list[str]]] = {}
        next_row = TaskContext.get().partitionId() << 40

        def looked_up(unit: str) -> tuple[int, list[str]]:
            pieces = find(unit)
            return sum(table.get(p, 0) for p in pieces), [p for p in pieces if p not in table]

        for batch in chunks(batches):
            texts = batch.column("text").to_pylist()
            keys = pa.array(np.arange(next_row, next_row + len(texts)))
            next_row += len(texts)
            sums, rest, owner, times = [], [], [], []
            for i, text in enumerate(texts):
                units, begins, n = cut(text) if text else ([], [], 0)
                own: dict[str, int] = {}
                for unit, repeats in Counter(units).items():
                    tokens, others = memo.get(unit) or memo.setdefault(unit, looked_up(" " + unit))
                    n += tokens * repeats
                    for piece in others:
                        own[piece] = own.get(piece, 0) + repeats
                for unit in begins:
                    tokens, others = looked_up(unit)
                    n += tokens
                    for piece in others:
                        own[piece] = own.get(piece, 0) + 1
                rest += own
                times += own.values()
                owner += [i] * len(own)
                sums.append(n)
            if len(memo) > HELD:
                memo.clear()
            size = pc.fill_null(pc.binary_length(batch.column("text")), 0).cast(pa.int64())
            none = pa.nulls(len(texts), pa.string())
            yield pa.RecordBatch.from_arrays(
                [keys, batch.column("key"), size, none, pa.array(sums, pa.int64())], ["row", "key", "n_bytes", "piece", "n"]
            )
            if rest:
                empty = pa.nulls(len(rest), batch.schema.field("key").type)
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(owner)), empty, pa.nulls(len(rest), pa.int64()), pa.array(rest, pa.string()), pa.array(times, pa.int64())],
                    ["row", "key", "n_bytes", "piece", "n"],
                )

    kind = texts.schema["key"].dataType.simpleString()
    parts = texts.mapInArrow(frequencies, f"row long, key {kind}, n_bytes long, piece string, n long")
    parts = parts.join(known.select("piece", "tokens"), "piece", "left")
    return (
        parts.groupBy("row")
        .agg(
            F.max("key").alias(key),
            F.max("n_bytes").alias("n_bytes"),
            F.sum(F.col("n") * F.coalesce("tokens", F.lit(1))).alias("n_tokens"),
        )
        .drop("row")
    )
