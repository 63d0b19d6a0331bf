"""Conversations as token sequences with a loss mask.

A turn is [TURN] role [CONTENT] text [END]. Role and text are encoded separately and the reserved
ids, which lie beyond the vocabulary, are spliced between them, so no text can produce one. Written
out, the reserved ids are control strings; where these occur inside a role or text a backslash
breaks them, so the written form can be split at control strings and read back too.
"""

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spokeline.llm.tokenizer import VOCABULARY, vocabulary
from spokeline.llm.words import slices

#: What the reserved ids (vocabulary size + 0, 1, 2) are written as.
CONTROL = ("### ", ": ", "</turn>\n")
TRAINED_ROLE = "assistant"

_RISKY = re.compile(r"\\|#(?=#)|<(?=/)")
_ESCAPE = re.compile(r"\\(.)", re.DOTALL)

FORMATTED = "conv_id long, seq long, token_start long, ids array<int>, loss array<boolean>"


def escape(text: str) -> str:
    """text without "##" and "</": a backslash follows their first character, and doubles itself."""
    return _RISKY.sub(lambda found: "\\\\" if found[0] == "\\" else found[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPE.sub(r"\1", text)


def _in_order(turns: DataFrame) -> DataFrame:
    columns = [F.col(c).cast("long") for c in ("conv_id", "turn")] + [
        F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")
    ]
    turns = turns.select(*columns)
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _assemble(build: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = build()
        reserved = [[encoding.n_vocab + i] for i in range(len(CONTROL))]
        last, seq, position = object(), 0, 0
        for batch in slices(batches):
            convs, roles, texts = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))
            segments = []
            for role, text in zip(roles, texts, strict=True):
                role, text = (encoding.encode_ordinary(escape(x)) for x in (role, text))
                segments += [reserved[0], role, reserved[1], text, reserved[2]]
            ends = np.cumsum([len(x) for x in segments])
            ids = np.array([i for x in segments for i in x], dtype=np.int32)
            # The mask is the running sum of +1 where a trained text begins and -1 where it ends.
            trained = np.array([role == TRAINED_ROLE for role in roles])
            change = np.zeros(len(ids) + 1, dtype=np.int32)
            np.add.at(change, ends[2::5][trained], 1)
            np.add.at(change, ends[3::5][trained], -1)
            mask = np.cumsum(change)[:-1] > 0
            bounds = np.concatenate([[0], ends[4::5]])
            seqs, starts = [], []
            for conv, n in zip(convs, np.diff(bounds).tolist(), strict=True):
                if conv != last:
                    last, seq, position = conv, 0, 0
                seqs.append(seq)
                starts.append(position)
                seq, position = seq + 1, position + n
            lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(x)) for x in (ids, mask)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(seqs, pa.int64()), pa.array(starts, pa.int64()), *lists],
                ["conv_id", "seq", "token_start", "ids", "loss"],
            )

    return run


def format_conversations(turns: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """One row per turn: conv_id, seq (its place from 0), token_start (tokens of the conversation
    before it), ids and loss (true for the tokens of an assistant's text).

    turns: conv_id, turn, role, text; other columns are ignored. A conversation's sequence is its
    rows' ids one after another, and its rows come one after another in one partition: they are
    sorted there and read as a stream, so a giant conversation needs no more memory than a short one.
    Null role or text: empty; null turn: first; rows of equal turn are ordered by role and text and
    all kept; rows with a null conv_id are one conversation.
    """
    return _in_order(turns).mapInArrow(_assemble(vocabulary(turns.sparkSession, path)), FORMATTED)


def _written(encoding, ids: np.ndarray) -> str:
    return encoding.decode(ids.tolist())


def _digests(build: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = build()
        turn, content, end = (encoding.n_vocab + i for i in range(3))
        around = sum(map(len, CONTROL))
        none = object()
        conv, state = none, None

        def row() -> tuple:
            n, all_text, chars, loss_text, formatted = state
            return conv, n, all_text.hexdigest(), chars, loss_text.hexdigest(), formatted

        def table(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            out = []
            for i, now in enumerate(batch.column("conv_id").to_pylist()):
                if now != conv:
                    if conv is not none:
                        out.append(row())
                    conv, state = now, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids = batch.column("ids")[i].values.to_numpy()
                mask = batch.column("loss")[i].values.to_numpy(zero_copy_only=False)
                at = int(np.flatnonzero(ids == content)[0])
                if ids[0] != turn or ids[-1] != end:
                    raise ValueError("a turn lacks its reserved ids")
                role, text = (_written(encoding, x) for x in (ids[1:at], ids[at + 1 : -1]))
                trained = unescape(_written(encoding, ids[mask]))
                state[0] += 1
                state[1].update(f"{unescape(role)}\n{unescape(text)}\n".encode("utf-8", "surrogatepass"))
                state[2] += len(trained)
                state[3].update(trained.encode("utf-8", "surrogatepass"))
                state[4] += len(role) + len(text) + around
            if out:
                yield table(out)
        if conv is not none:
            yield table([row()])

    return run


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = F.lit("\\### Assistant: </turn> ok").alias("text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role")
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role, said)
    return format_conversations(turns.unionByName(own)).mapInArrow(
        _digests(vocabulary(spark)),
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


ORACLE_SQL = r"""
WITH all_turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, n, CASE n WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok'
  FROM (SELECT unnest([0, 1]) AS n)
), escaped AS (
  SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss,
    replace(text, '\', '\\') AS a, replace(role, '\', '\\') AS b FROM all_turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(length(loss))::BIGINT AS loss_chars,
  sha256(string_agg(loss, '' ORDER BY turn, role, text)) AS loss_sha256,
  sum(14 + length(a) + length(b)
    + length(text) - length(replace(text, '</', '<'))
    + length(role) - length(replace(role, '</', '<'))
    + coalesce(list_sum(list_transform(regexp_extract_all(text, '#+'), lambda h: length(h) - 1)), 0)
    + coalesce(list_sum(list_transform(regexp_extract_all(role, '#+'), lambda h: length(h) - 1)), 0)
  )::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""
