"""Repair of conversations whose structure is damaged.

Rows are range-partitioned by conversation and turn, so that a long conversation spreads
over tasks like many short ones. A task walks through its rows in order and cuts them into
pieces of PIECE_ROWS rows of one conversation at most. A conversation that lies within one
piece is repaired there. Of the others every piece states the cheapest audits from each
state of the pattern to each other one (``audits.py``); those are joined, without texts,
by conversation, and every piece is repaired with its part of the best audit.

A conversation has one audit and one digest, which take its rows in order: what one task
does per long conversation is a step for each piece, and the digest of its texts, which are
streamed piece by piece and never held together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from playmart.llm import audits
from playmart.llm.common import bound_batches, table
from playmart.operators import Scratch
from playmart.operators.numbering import range_partitions

#: The most rows and characters of one piece.
PIECE_ROWS, PIECE_CHARS = 1024, 4_000_000
#: Characters of pieces that are handed on together.
BATCH_CHARS = 8_000_000
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
ENDS = ".!?"
LEGAL = {"su", "ua", "au"}
DAMAGE_KINDS = 20

FACTS = "n bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, least bigint, most bigint, turns bigint"
OPTIONS = "array<struct<entry:int,exit:int,cost:bigint,audit:string>>"
ROWS = "array<struct<role:string,text:string,copies:bigint,dropped:boolean,truncated:boolean>>"
TURNS = "array<struct<role:string,text:string>>"
PIECES = (
    f"conv_key string, place bigint, whole boolean, {FACTS}, initial_first string, initial_last string, "
    f"cost bigint, audit string, options {OPTIONS}, damaged {ROWS}, repaired {TURNS}, repaired_sha256 string"
)
CHOICES = f"conv_key string, place bigint, last boolean, {FACTS}, cost bigint, entry int, part string, audit string"


def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, gone) with the damage that their key decides.

    Null roles and texts become one space, as nulls do in the key. A dropped row is kept
    as ``gone``, so that its conversation is still known.
    """
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % DAMAGE_KINDS
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    text = F.when(kind == 1, "").when(kind == 2, F.translate(text, ENDS, "")).otherwise(text)
    times = F.when(kind == 3, 2).otherwise(1)
    row = F.struct(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        text.alias("text"),
        (kind == 0).alias("gone"),
    )
    return conversations.select(F.explode(F.array_repeat(row, times)).alias("r")).select("r.*")


def _ordered(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Different rows in order, with their number of copies, whether they are the first of
    their role and text, and their place."""
    known = rows.select(
        F.when(F.col("conv_id").isNull(), "-").otherwise(F.concat(F.lit(":"), F.col("conv_id").cast("string"))).alias("conv_key"),
        F.when(~F.col("gone"), F.col("turn")).alias("turn"),
        F.when(~F.col("gone"), F.col("role")).alias("role"),
        F.when(~F.col("gone"), F.col("text")).alias("text"),
    )
    same = ["conv_key", "turn", "role", "text"]
    digest = F.sha2("text", 256).alias("digest")
    distinct = known.groupBy(*same).agg(F.count(F.lit(1)).alias("copies")).select("*", digest)
    distinct = scratch.write("distinct", distinct)
    present = distinct.filter(F.col("role").isNotNull())
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"))
    firsts = present.groupBy("conv_key", "role", "digest").agg(F.min(turn).alias("turn_key")).withColumn("first", F.lit(True))
    marked = distinct.withColumn("turn_key", turn).join(firsts, ["conv_key", "role", "digest", "turn_key"], "left")
    order = ["conv_key", "turn", "role", "digest"]
    marked = scratch.write("marked", marked.select(*same, "copies", "digest", F.coalesce("first", F.lit(False)).alias("first")))
    scratch.drop("distinct")
    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = range_partitions(scratch.bytes("marked"), marked.count(), cores)
    laid = marked.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return laid.withColumn("place", F.monotonically_increasing_id()).drop("digest")


def _facts(turns: list[tuple[int | None, audits.Row, str]]) -> tuple[dict, list[audits.Row]]:
    """Counts over a piece's rows, given with their turn and fault; and the rows."""
    counts = dict.fromkeys(["n", "blank", "duplicate", "truncated", "illegal", "turns"], 0)
    seen: list[int] = []
    before = None
    for turn, row, fault in turns:
        counts["n"] += row.copies
        if fault:
            counts[fault] += 1
        counts["blank" if fault == "blank" else "duplicate"] += row.copies - 1
        initial = row.role[:1]
        counts["illegal"] += (before is not None and before + initial not in LEGAL) + (row.copies - 1) * (initial * 2 not in LEGAL)
        before = initial
        if turn is not None and (not seen or seen[-1] != turn):
            seen.append(turn)
    counts["turns"] = len(seen)
    ends = {"least": seen[0] if seen else None, "most": seen[-1] if seen else None}
    ends |= {"initial_first": turns[0][1].role[:1] if turns else None, "initial_last": before}
    return counts | ends, [row for _, row, _ in turns]


def _judged(role: str, text: str, copies: int, first: bool) -> tuple[audits.Row, str]:
    """The row and its first fault, or an empty string."""
    body = text.rstrip(WHITE)
    fault = "blank" if not body else "duplicate" if not first else "truncated" if body[-1] not in ENDS else ""
    return audits.Row(role, text, copies, fault in ("blank", "duplicate"), fault == "truncated"), fault


def digest(turns: list[tuple[str, str]]) -> bytes:
    return "\n".join(f"{role}:{text}" for role, text in turns).encode()


def _piece(key: str, place: int, turns: list, opening: bool, whole: bool) -> dict:
    """``opening``: the conversation begins here; ``whole``: it ends here, too."""
    facts, rows = _facts(turns)
    made = {"conv_key": key, "place": place, "whole": whole, **facts, "options": [], "damaged": [], "repaired": []}
    if whole:
        cost, node = audits.final(audits.run(rows, audits.EMPTY))
        made |= {"cost": cost, "audit": audits.text(node)}
        made["repaired"] = audits.apply(rows, made["audit"], audits.EMPTY)
        return made | {"repaired_sha256": sha256(digest(made["repaired"])).hexdigest()}
    entries = [audits.EMPTY] if opening else audits.STATES
    if rows:
        made["options"] = [
            (entry, state, best.cost, audits.text(best.node)) for entry in entries for state, best in audits.run(rows, entry).items()
        ]
    return made | {"damaged": [tuple(r) for r in rows], "cost": None, "audit": None, "repaired_sha256": None}


def _pieces(batches: Iterator[pa.RecordBatch], schema: pa.Schema, most_rows: int) -> Iterator[pa.RecordBatch]:
    key, place, held, chars, opening, first = None, 0, [], 0, False, True
    out, size = [], 0

    def close(whole: bool) -> None:
        nonlocal held, chars, size
        out.append(_piece(key, place, held, opening, whole))
        size += chars
        held, chars = [], 0

    for batch in batches:
        for row in batch.to_pylist():
            if row["conv_key"] != key or key is None:
                if key is not None:
                    close(opening)
                    first = False
                key, place, opening = row["conv_key"], row["place"], not first
            elif len(held) >= most_rows or chars >= PIECE_CHARS:
                close(False)
                place, opening = row["place"], False
            if row["role"] is not None:
                judged, fault = _judged(row["role"], row["text"], row["copies"], row["first"])
                held.append((row["turn"], judged, fault))
                chars += len(row["text"]) + len(row["role"])
            if size >= BATCH_CHARS or len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, size = [], 0
    if key is not None:
        close(False)
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _joined(before: dict | None, piece: dict) -> dict:
    """The counts of a conversation up to and with a piece."""
    if before is None or not piece["n"]:
        return piece if before is None else before
    if not before["n"]:
        return piece
    names = ["n", "blank", "duplicate", "truncated", "illegal", "turns"]
    both = piece | {c: before[c] + piece[c] for c in names}
    both["illegal"] += before["initial_last"] + piece["initial_first"] not in LEGAL
    if before["most"] is None:
        return both
    if piece["least"] is None:
        return both | {"least": before["least"], "most": before["most"]}
    both["turns"] -= before["most"] == piece["least"]
    return both | {"least": before["least"]}


def _choose(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The best audit of each conversation, from the options of its pieces in order."""
    facts = ["n", "blank", "duplicate", "truncated", "illegal", "least", "most", "turns"]
    key, places, counts, best = None, [], None, {}

    def chosen() -> Iterator[pa.RecordBatch]:
        cost, node = audits.final(best)
        parts = [(entry, label) for entry, label in audits.labels(node) if label]
        inserted = ""
        while parts and len(parts) > len(places):  # turns inserted at the very end
            inserted = parts.pop()[1] + inserted
        out, chars = [], 0
        for i, (at, part) in enumerate(zip(places, parts, strict=True)):
            label = part[1] + inserted if i == len(places) - 1 else part[1]
            out.append({"conv_key": key, "place": at, "last": False, "entry": part[0], "part": label})
            chars += len(label)
            if chars > BATCH_CHARS:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, chars = [], 0
        summary = {"conv_key": key, "place": None, "last": True, "cost": cost, "audit": audits.text(node)}
        out.append(summary | {c: counts[c] for c in facts})
        yield pa.RecordBatch.from_pylist(out, schema)

    for batch in batches:
        for piece in batch.to_pylist():
            if piece["conv_key"] != key:
                if key is not None:
                    yield from chosen()
                key, places, counts = piece["conv_key"], [], None
                best = {audits.EMPTY: audits.Best(0, audits.Node(None, ""))}
            counts = _joined(counts, piece)
            if not piece["n"]:
                continue
            places.append(piece["place"])
            after: audits.Audits = {}
            for option in piece["options"]:
                if option["entry"] in best:
                    cost, node = best[option["entry"]]
                    audits.offer(after, option["exit"], cost + option["cost"], node, option["audit"], option["entry"])
            best = after
    if key is not None:
        yield from chosen()


def _repaired(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            piece = batch.slice(i, 1).to_pylist()[0]
            rows = [audits.Row(r["role"], r["text"], r["copies"], r["dropped"], r["truncated"]) for r in piece["damaged"]]
            turns = audits.apply(rows, piece["part"], piece["entry"])
            row = {"conv_key": piece["conv_key"], "place": piece["place"], "repaired": turns}
            yield pa.RecordBatch.from_pylist([row], schema)


def _digests(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One running digest per conversation over its pieces in order."""
    key, running, any_turn = None, sha256(), False
    for batch in batches:
        for i in range(batch.num_rows):
            piece = batch.slice(i, 1).to_pylist()[0]
            if piece["conv_key"] != key:
                if key is not None:
                    yield pa.RecordBatch.from_pylist([{"conv_key": key, "repaired_sha256": running.hexdigest()}], schema)
                key, running, any_turn = piece["conv_key"], sha256(), False
            if piece["repaired"]:
                turns = [(t["role"], t["text"]) for t in piece["repaired"]]
                running.update((b"\n" if any_turn else b"") + digest(turns))
                any_turn = True
    if key is not None:
        yield pa.RecordBatch.from_pylist([{"conv_key": key, "repaired_sha256": running.hexdigest()}], schema)


def _mapped(df: DataFrame, function: Callable, schema: str, *rest: int) -> DataFrame:
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return df.mapInArrow(lambda batches: function(batches, arrow, *rest), schema)


def repair(rows: DataFrame, scratch: Scratch, piece_rows: int = PIECE_ROWS) -> tuple[DataFrame, DataFrame]:
    """(conversations, pieces) of rows (conv_id, turn, role, text, gone).

    Conversations have their faults, the cheapest audit, its cost and the digest of the
    repaired turns. Pieces have those turns: ``repaired`` arrays in the order of ``place``.

    Rows stand by turn, null first; rows of one turn by role and then by the digest of
    their text, equal rows side by side. A row of equal role and text after another one is
    a duplicate, whatever their turns. A null id is a conversation of its own. A role
    without characters has no initial and may stand anywhere. A conversation whose rows
    are all ``gone`` has zeros, an empty audit and the digest of nothing. An empty table
    gives empty ones. Other columns are passed over.
    """
    spark = rows.sparkSession
    bound_batches(spark)
    kind = rows.schema["conv_id"].dataType
    pieces = scratch.write("pieces", _mapped(_ordered(rows, scratch), _pieces, PIECES, piece_rows))
    scratch.drop("marked")
    parts = pieces.filter(~F.col("whole"))
    facts = [f.split()[0] for f in FACTS.split(", ")]
    summaries = parts.select("conv_key", "place", *facts, "initial_first", "initial_last", "options")
    in_order = summaries.repartition("conv_key").sortWithinPartitions("conv_key", "place")
    choices = scratch.write("choices", _mapped(in_order, _choose, CHOICES))
    chosen = choices.filter(~F.col("last")).select("place", "entry", "part")
    mended = parts.select("conv_key", "place", "damaged").join(chosen, "place")
    mended = scratch.write("mended", _mapped(mended, _repaired, f"conv_key string, place bigint, repaired {TURNS}"))
    streamed = mended.repartition("conv_key").sortWithinPartitions("conv_key", "place")
    digests = _mapped(streamed, _digests, "conv_key string, repaired_sha256 string")

    gaps = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0)).cast("bigint").alias("gaps")
    results = [gaps, "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    long = choices.filter("last").join(digests, "conv_key", "left")
    nothing = F.coalesce("repaired_sha256", F.lit(sha256(b"").hexdigest()))
    found = pieces.filter("whole").select("conv_key", *results).unionByName(
        long.withColumn("repaired_sha256", nothing).select("conv_key", *results)
    )
    conv_id = F.when(F.col("conv_key") != "-", F.substr("conv_key", F.lit(2))).cast(kind).alias("conv_id")
    turns = pieces.filter("whole").select("conv_key", "place", "repaired").unionByName(mended)
    return found.select(conv_id, *found.columns[1:]), turns.select(conv_id, "place", "repaired")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by rule and repaired."""
    return repair(damage(table(spark, sf_dir, "conversations")), Scratch(spark, "conversations"))[0]
