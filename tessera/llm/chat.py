"""Chat formatting by quotation linking.

Every message is parsed into its own lines and quoted lines with their nesting level ("> > text", attribution lines such as
"On Monday, Ann wrote:" belong to the quote below them). Passages (runs of lines of one level, and their single lines) are
normalised and hashed; a quoted passage joins the first message of the same conversation whose own text has that passage. So do
fragments, which need no equal line ends: windows of WIDTH words of quoted text, and quoted sentences of 2 to WIDTH - 1 words, meet
any own text that holds these words on end (signs of scripts without spaces count as words). Passages under LEAST characters link
where they are the whole own text of a message. The
parent of a message is the earlier message that most characters of its outermost quotes come from; deeper levels count where
the outermost link nothing. Conversations are then put in reply order: thread after thread by the turn that opens it, messages
of a thread by turn, so that a reply always follows what it answers, and what links is left out of the text. Lines that look quoted
but link to nothing (a prompt, a heading, a quote from elsewhere) stay as they are.

Rows stay rows: a conversation is never gathered into one task. Positions come from a range partitioning with pre-aggregated
offsets, so that a conversation that holds a third of all rows is dealt over many tasks.

Defined cases: null text is an empty message; a message of linked quotes alone has empty text; a quote that matches nothing stays
and leaves its message in a thread of its own; of messages with equal passages the first is the original; rows that share (conv_id, turn)
are one message for links and keep their rows; a null conv_id or turn links with nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from xxhash import xxh64_intdigest

from .common import materialize, mixed

QUOTE = re.compile(r"[ \t]{0,3}((?:[>|»][ \t]?)+)")
ATTRIBUTION = re.compile(r"(?:on|am|le|el)\b.{1,200}\b(?:wrote|schrieb|écrit|escribió)\s?:\s*$|.{1,100}\b(?:wrote|writes)\s?:\s*$", re.IGNORECASE)
#: Shorter passages (characters after normalisation) say too little to link by, unless they are a whole message.
LEAST = 8
WIDTH = 5
WORD = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]|(?:(?![\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])\w)+")
SENTENCE = re.compile(r"[.!?…。！？]+")
KIND = "turn long, role string, own string, quoted array<struct<level:int,hash:long,size:int>>, passages array<long>, pieces array<struct<level:int,hash:long,size:int>>, raw string"


def levels(text: str | None) -> list[tuple[int, str]]:
    """(quote level, line without its marks) of each line; attribution lines just above a deeper quote have level -1."""
    out = []
    for line in (text or "").split("\n"):
        m = QUOTE.match(line)
        # a bar marks a quote only at the line's start and with text behind it, as ">" does
        level = sum(c in ">»|" for c in m[1]) if m and (m[1].strip()[0] in ">»") else 0
        out.append((level, line[m.end() :] if level else line))
    below = 0  # level of the next line with text
    for i in range(len(out) - 1, -1, -1):
        level, line = out[i]
        if below > level and ATTRIBUTION.match(line.strip()):
            out[i] = (-1, line)
        if line.strip():
            below = level
    return out


def normal(lines: list[str]) -> str:
    return " ".join(" ".join(lines).lower().split())


def passages(lines: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """(level, normalised passage): runs of lines of one level, their paragraphs and their lines, without repeats."""
    found: dict[tuple[int, str], None] = {}
    run: list[str] = []
    for i, (level, line) in enumerate([*lines, (-2, "")]):
        if run and level != lines[i - 1][0]:
            at = lines[i - 1][0]
            paragraph: list[str] = []
            for x in [*run, ""]:
                if x.strip():
                    paragraph.append(x)
                    found[at, normal([x])] = None
                elif paragraph:
                    found[at, normal(paragraph)] = None
                    paragraph = []
            found[at, normal(run)] = None
            run = []
        if level > -1:
            run.append(line)
    return [x for x in found if x[1]]


def grams(text: str) -> tuple[list[np.ndarray], np.ndarray]:
    """(hashes of the runs of 1, 2, ... WIDTH words, characters before each word and after the last) of a normalised text."""
    words = WORD.findall(text)
    out = [np.fromiter((xxh64_intdigest(w.encode("utf-8", "replace"), 7) for w in words), dtype=np.uint64, count=len(words))]
    for n in range(2, WIDTH + 1):
        out.append(mixed(out[-1][:-1], out[0][n - 1 :]))
    return out, np.cumsum([0, *map(len, words)])


def signed(h: np.ndarray) -> list[int]:
    return h.view(np.int64).tolist()


def fragments(lines: list[tuple[int, str]]) -> list[tuple[int, int, int]]:
    """(level, hash, size) of the windows and short sentences of quoted text, without repeats; sizes add up to its characters."""
    found: dict[tuple[int, int], int] = {}
    runs: list[tuple[int, list[str]]] = []
    for level, line in lines:
        if not runs or runs[-1][0] != level:
            runs.append((level, []))
        runs[-1][1].append(line)
    for level, run in runs:
        if level < 1:
            continue
        text = normal(run)
        g, at = grams(text)
        for i, h in enumerate(signed(g[-1])):
            if at[i + WIDTH] - at[i] + WIDTH - 1 >= LEAST:
                found.setdefault((level, h), int((at[-1] if i + 1 == len(g[-1]) else at[i + 1]) - at[i]))
        for part in SENTENCE.split(text):
            g, at = grams(part)
            n = len(at) - 1
            if 2 <= n < WIDTH and at[-1] + n - 1 >= LEAST:
                found.setdefault((level, signed(g[n - 1])[0]), int(at[-1]))
    return [(level, h, size) for (level, h), size in found.items()]


def own_fragments(own: str) -> list[int]:
    """Hashes of all runs of 2 to WIDTH words that could answer a fragment."""
    g, at = grams(normal([own]))
    out: set[int] = set()
    for n in range(2, WIDTH + 1):
        if len(g[n - 1]):
            out.update(signed(g[n - 1][at[n:] - at[:-n] + n - 1 >= LEAST]))
    return sorted(out)


def hashed(lines: list[tuple[int, str]]) -> list[tuple[int, int, int]]:
    """(level, hash, size) of the passages; short ones have hashes of their own, which only whole messages share."""
    return [(level, xxh64_intdigest(p.encode("utf-8", "replace"), 5 if len(p) >= LEAST else 6) - (1 << 63), len(p)) for level, p in passages(lines)]


def tidy(lines: list[str]) -> str:
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


def without(text: str, linked: set[int]) -> str:
    """The text less its runs of quoted lines of which any passage or fragment is linked, and less their attribution lines."""
    lines, raw = levels(text), text.split("\n")
    out: list[str] = []
    intro: list[str] = []  # attribution lines wait for the quote below them
    at = 0
    while at < len(lines):
        level, to = lines[at][0], at + 1
        while to < len(lines) and lines[to][0] == level:
            to += 1
        run = lines[at:to]
        if level == -1:
            intro += raw[at:to]
        elif level > 0 and any(h in linked for _, h, _ in chain(hashed(run), fragments(run))):
            intro = []
        elif intro and level == 0 and not any(x.strip() for _, x in run):
            intro += raw[at:to]  # empty lines between an attribution and its quote
        else:
            out += intro + raw[at:to]
            intro = []
        at = to
    return tidy(out + intro)


def parse(text: str | None) -> tuple[str, list[tuple[int, int, int]], list[int], list[tuple[int, int, int]]]:
    """(own text, quoted passages as (level, hash, size), hashes of own passages, quoted fragments)."""
    lines = levels(text)
    own = tidy([x for level, x in lines if level == 0])
    found = hashed(lines)
    whole = normal([own])
    answers = [h for level, h, size in found if level == 0 and (size >= LEAST or size == len(whole))]
    quoted = [x for x in found if x[0] > 0]
    return own, quoted, answers, fragments(lines) if quoted else []


def parsed(turns: DataFrame) -> DataFrame:
    kind = turns.schema["conv_id"].dataType.simpleString()
    quoted = pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.int64()), ("size", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            each = [parse(t) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    b["conv_id"], b["turn"], b["role"], pa.array([x[0] for x in each], pa.string()),
                    pa.array([[dict(zip(("level", "hash", "size"), q, strict=True)) for q in x[1]] for x in each], quoted),
                    pa.array([x[2] for x in each], pa.list_(pa.int64())),
                    pa.array([[dict(zip(("level", "hash", "size"), q, strict=True)) for q in x[3]] for x in each], quoted),
                    pa.array([t if x[1] else None for t, x in zip(b["text"].to_pylist(), each, strict=True)], pa.string()),
                ],
                ["conv_id", "turn", "role", "own", "quoted", "passages", "pieces", "raw"],
            )

    return turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), "text").mapInArrow(run, f"conv_id {kind}, {KIND}")


def parents(messages: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, parent, links, linked): the message that each quoting message answers, and the hashes that link."""
    each = [messages.select("conv_id", "turn", F.explode(c).alias("q"), F.lit(whole).alias("whole")) for c, whole in (("quoted", 1), ("pieces", 0))]
    quoted = each[0].unionByName(each[1]).select("conv_id", "turn", "q.*", "whole").distinct()
    asked = quoted.select("conv_id", "hash").distinct()
    own = messages.select("conv_id", "turn", F.explode("passages").alias("hash"))
    own = own.unionByName(pieces_of(messages)).join(asked, ["conv_id", "hash"], "left_semi")
    first = own.groupBy("conv_id", "hash").agg(F.min("turn").alias("parent"))
    met = quoted.join(first, ["conv_id", "hash"]).where("parent < turn")
    # characters from each candidate by level; the outermost level that links decides, then size, then the later message
    by = met.groupBy("conv_id", "turn", "level", "parent").agg(F.sum("size").alias("size"), F.sum("whole").alias("n"))
    best = F.max_by("parent", F.struct(-F.col("level"), F.col("size"), F.col("parent"))).alias("parent")
    each = by.groupBy("conv_id", "turn").agg(best, F.greatest(F.sum("n"), F.lit(1)).alias("links"))
    # at most the hashes of one message
    return each.join(met.groupBy("conv_id", "turn").agg(F.collect_set("hash").alias("linked")), ["conv_id", "turn"])


def pieces_of(messages: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, hash) of the fragments of own text, of the conversations that quote anything."""
    kind = messages.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.slice(at, 256)
                each = [own_fragments(t) for t in part["own"].to_pylist()]
                rows = pa.array(np.repeat(np.arange(len(each)), [len(x) for x in each]))
                hashes = pa.array([h for x in each for h in x], pa.int64())
                yield pa.RecordBatch.from_arrays([part["conv_id"].take(rows), part["turn"].take(rows), hashes], ["conv_id", "turn", "hash"])

    quoting = messages.where(F.size("pieces") > 0).select("conv_id").distinct()
    return messages.select("conv_id", "turn", "own").join(quoting, "conv_id", "left_semi").mapInArrow(run, f"conv_id {kind}, turn long, hash long")


def threads(links: DataFrame, rounds: int = 60) -> DataFrame:
    """links(conv_id, turn, parent) with root: the turn at the top, by pointer jumping."""
    now = links.select("conv_id", "turn", "parent", F.col("parent").alias("root"))
    for _ in range(rounds):
        now = materialize(now, "threads")
        up = now.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("above"))
        ahead = now.join(up, ["conv_id", "root"], "left")
        if ahead.where("above is not null").isEmpty():
            return now
        now = ahead.select("conv_id", "turn", "parent", F.coalesce("above", "root").alias("root"))
    raise RuntimeError("replies are nested too deeply")


def format_chats(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, position, turn, role, text, reply_to, thread, n_quotes, n_links) for every row of turns.

    position counts from 0 within a conversation, in reply order; text has no quotes that link; reply_to is the turn answered, if any;
    n_links counts the passages of n_quotes that link, 1 where only fragments do.
    """
    messages = materialize(parsed(turns), "messages")
    links = materialize(parents(messages), "parents")
    found = threads(links).join(links.select("conv_id", "turn", "links", "linked"), ["conv_id", "turn"])
    rows = messages.drop("passages", "pieces").withColumn("n_quotes", F.size("quoted")).drop("quoted").join(found, ["conv_id", "turn"], "left")
    rows = with_text(rows.withColumn("thread", F.coalesce("root", "turn")))
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["thread", "turn", "role", "own"]
    dealt = materialize(rows.repartitionByRange(n, "conv_id", *order).withColumn("part", F.spark_partition_id()), "ordered")
    here = dealt.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    # at most one row a conversation and range partition
    before = here.withColumn("before", F.coalesce(F.sum("n").over(W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    before = before.select(F.col("conv_id").alias("__conv"), F.col("part").alias("__part"), "before")
    within = dealt.withColumn("rank", F.row_number().over(W.partitionBy("conv_id", "part").orderBy(*order)))
    out = within.join(before, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("part") == F.col("__part")))
    return out.select(
        "conv_id", (F.col("rank") - 1 + F.col("before")).alias("position"), "turn", "role", F.col("own").alias("text"),
        F.col("parent").alias("reply_to"), "thread", "n_quotes", F.coalesce("links", F.lit(0)).cast("int").alias("n_links"),
    )


def with_text(rows: DataFrame) -> DataFrame:
    """rows with own as the text that stays, less raw and linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [o if r is None else without(r, set(h or ())) for o, r, h in zip(b["own"].to_pylist(), b["raw"].to_pylist(), b["linked"].to_pylist(), strict=True)]
            yield b.select(names).set_column(names.index("own"), "own", pa.array(own, pa.string()))

    names = [c for c in rows.columns if c not in ("raw", "linked")]
    return rows.mapInArrow(run, rows.select(names).schema)


def templated(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, position, line): each message in chat markup, for writing conversations out in order."""
    line = F.concat(F.lit("<|"), F.coalesce("role", F.lit("user")), F.lit("|>\n"), "text", F.lit("\n<|end|>"))
    return rows.select("conv_id", "position", line.alias("line"))
