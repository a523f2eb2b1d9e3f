"""Words of a corpus grouped with their spelling variants: words one inserted, deleted or replaced character apart.

Every word's prefixes are nodes of a trie, its suffixes nodes of the trie of reversed words, and both tries'
nodes are numbered. A word with its i-th character left out is the pair (node of what comes before, node of
what comes after); a word split before its i-th character is such a pair too. Two words that share a pair with
a character left out differ in that character alone; a pair with a character left out that is another word's
split says that the one is the other with a character inserted. So equal pairs of integers are exactly the
near words, and no strings are compared. A pair's words differ in one character each, so there are at most as
many as letters.

Tries are numbered from sorted words: a word's nodes are those of the word before it as far as the two agree,
and new numbers after that. The first words of a partition go on with nodes of the partition before, which a
list of each partition's two outermost words settles.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Steps

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = "a-zÀ-ÿ"
MIN_CHARS = 6
MIN_COUNT = 5
# A word's form is at least so many times as frequent.
RATIO = 5
# One occurrence in so many loses a character: the misspellings that the query finds.
TYPO_EVERY = 199

# What a row of a pair says: the word split there, a character left out, or one left out that equals the one before it.
SPLIT, SKIP, SKIP_AGAIN = 0, 1, 2


def word_counts(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, typo_every: int | None = None) -> DataFrame:
    """``word, n`` of runs of letters, lower case in A-Z, with at least so many characters and occurrences.

    With ``typo_every``, an occurrence whose crc32 with its document's id is a multiple loses the character at the
    crc32 modulo the length. Null texts have no words; a null id reads as an empty one."""
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER)
    # A match starts where a run starts and takes all of it; shorter runs give no word.
    runs = F.regexp_extract_all(text, F.lit(f"[{LETTERS}]{{{min_chars},}}"), F.lit(0))
    own = docs.select(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":")).alias("_doc"), F.explode(runs).alias("word"))
    if typo_every:
        crc = own.withColumn("_crc", F.crc32(F.concat("_doc", "word").cast("binary")))
        at = (F.col("_crc") % F.length("word")).cast("int")
        cut = F.concat(F.substr("word", F.lit(1), at), F.substr("word", at + 2))
        own = crc.withColumn("word", F.when(F.col("_crc") % typo_every == 0, cut).otherwise(F.col("word")))
    return own.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") >= min_count) & (F.length("word") >= min_chars))


def _shared(one: str, other: str) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(one), len(other))
    if one[:high] == other[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if one[:middle] == other[:middle]:
            low = middle
        else:
            high = middle
    return low


def with_nodes(steps: Steps, words: DataFrame, key, name: str) -> tuple[DataFrame, dict[int, int]]:
    """``words`` with the array ``name`` of the nodes of all prefixes of ``key``, the empty one first, and what to
    read in place of some nodes; ``number`` orders words by key.

    A node is its first word's number plus its depth. Words must differ in ``key``; what to read in place is at most
    one word's nodes per partition."""
    kept = words.columns
    fields = list(words.schema)

    def numbered(batches):
        part = TaskContext.get().partitionId()
        before, nodes, free, first, held = "", [], part << 40, True, None
        for batch in batches:
            numbers, paths = [], []
            for word in batch.column("_key").to_pylist():
                shared = _shared(before, word) + 1 if nodes else 0
                nodes = nodes[:shared] + list(range(free + shared, free + len(word) + 1))
                numbers.append(free)
                paths.append(nodes)
                free += len(word) + 1
                before = word
            if not numbers:
                continue
            if held:
                yield told(*held, False)
            held = (batch, numbers, paths, first)
            first = False
        if held:
            yield told(*held, True)

    def told(batch, numbers, paths, first, last):
        edge = [0] * len(numbers)
        edge[0] += 1 if first else 0
        edge[-1] += 2 if last else 0
        return pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in kept], pa.array(numbers, pa.int64()), pa.array(paths, pa.list_(pa.int64())),
             pa.array([numbers[0] >> 40] * len(numbers), pa.int32()), batch.column("_key"), pa.array(edge, pa.int32())],
            names=[*kept, "_number", name, "_part", "_key", "_edge"],
        )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    schema += f", _number bigint, {name} array<bigint>, _part int, _key string, _edge int"
    ranged = words.withColumn("_key", key).repartitionByRange("_key").sortWithinPartitions("_key")
    written = steps.table(ranged.mapInArrow(numbered, schema))
    edges = written.where("_edge > 0").select("_part", "_edge", "_key", name).orderBy("_part", "_number").collect()
    instead: dict[int, int] = {}
    last_word, last_path = None, []
    for edge in edges:
        path = [instead.get(node, node) for node in edge[name]]
        if edge["_edge"] & 1 and last_word is not None:
            shared = _shared(last_word, edge["_key"]) + 1
            instead |= dict(zip(path[:shared], last_path[:shared]))
            path = [instead.get(node, node) for node in path]
        last_word, last_path = edge["_key"], path
    return written, instead


def pairs(words: DataFrame, before: dict[int, int], after: dict[int, int]) -> DataFrame:
    """``p, s, number, n, kind``: every word's splits and left-out characters as pairs of nodes."""

    def emitted(batches):
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            p, s, number, n, kind = columns
            for word, own, count, heads, tails in zip(*(batch.column(c).to_pylist() for c in ("word", "number", "n", "heads", "tails"))):
                heads = [before.get(x, x) for x in heads]
                tails = [after.get(x, x) for x in reversed(tails)]
                size = len(word)
                p += heads
                s += tails
                kind += [SPLIT] * (size + 1)
                p += heads[:-1]
                s += tails[1:]
                kind += [SKIP if i == 0 or word[i] != word[i - 1] else SKIP_AGAIN for i in range(size)]
                number += [own] * (2 * size + 1)
                n += [count] * (2 * size + 1)
            if p:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind_) for c, kind_ in zip(columns, (*[pa.int64()] * 4, pa.int8()))], names=["p", "s", "number", "n", "kind"]
                )

    return words.mapInArrow(emitted, "p bigint, s bigint, number bigint, n bigint, kind tinyint")


def near_words(paired: DataFrame) -> DataFrame:
    """``number, n, n_near, best_n, best``: how many near words a word has, and the most frequent (ties: first) one.

    Of equal characters in a row only the first left out counts as an insertion, so each near word counts once."""
    members = paired.groupBy("p", "s").agg(
        F.collect_list(F.struct("n", (-F.col("number")).alias("minus"), "kind")).alias("all")
    ).where(F.size("all") > 1)

    def near(x, y):
        both = (x["kind"] != SPLIT) & (y["kind"] != SPLIT) & (x["minus"] != y["minus"])
        inserted = ((x["kind"] == SKIP) & (y["kind"] == SPLIT)) | ((x["kind"] == SPLIT) & (y["kind"] == SKIP))
        return both | inserted

    own = members.select(
        F.explode(F.transform("all", lambda x: F.struct(x["minus"].alias("minus"), x["n"].alias("n"), F.filter("all", lambda y: near(x, y)).alias("near")))).alias("_m")
    ).where(F.size("_m.near") > 0)
    return (
        own.select("_m.minus", "_m.n", F.size("_m.near").alias("_k"), F.array_max("_m.near").alias("_best"))
        .groupBy("minus")
        .agg(F.first("n").alias("n"), F.sum("_k").alias("n_near"), F.max(F.struct("_best.n", "_best.minus")).alias("_best"))
        .select((-F.col("minus")).alias("number"), "n", "n_near", F.col("_best.n").alias("best_n"), (-F.col("_best.minus")).alias("best"))
    )


def roots(steps: Steps, forms: DataFrame) -> DataFrame:
    """``number, root``: the last word on the way from form to form, by doubling. Forms grow by ``RATIO``, so ways are short."""
    here = steps.table(forms.select("number", F.col("best").alias("root")))
    while True:
        there = here.select(F.col("number").alias("root"), F.col("root").alias("_next"))
        further = steps.table(here.join(there, "root", "left"))
        steps.free(here)
        here = further.select("number", F.coalesce("_next", "root").alias("root"))
        if further.where("_next IS NOT NULL").isEmpty():
            return here


def variants(counts: DataFrame, steps: Steps, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of a table ``word, n`` of distinct words.

    ``form`` is the near word with the largest ``n`` (ties: first in code-point order) if that is at least ``ratio``
    times the word's own; ``root`` follows forms to the last. A word without near words has 0 and is its own root;
    an empty table gives an empty result. Null words take no part.
    """
    plain = steps.table(counts.where("word IS NOT NULL").select("word", F.col("n").cast("bigint").alias("n")))
    heads, before = with_nodes(steps, plain, F.col("word"), "heads")
    ordered = heads.select("word", "n", F.col("_number").alias("number"), "heads")
    tails, after = with_nodes(steps, ordered, F.reverse("word"), "tails")
    near = steps.table(near_words(pairs(tails, before, after)))
    forms = near.where(F.col("best_n") >= ratio * F.col("n"))
    names = ordered.select("number", "word")
    form_names = names.select(F.col("number").alias("best"), F.col("word").alias("form"))
    root_names = names.select(F.col("number").alias("root"), F.col("word").alias("root_word"))
    named = (
        forms.select("number", "best", F.col("best_n").alias("form_n"))
        .join(form_names, "best")
        .join(roots(steps, forms), "number")
        .join(root_names, "root")
        .select("number", "form", "form_n", "root_word")
    )
    return (
        ordered.select("number", "word", "n")
        .join(near.select("number", "n_near"), "number", "left")
        .join(named, "number", "left")
        .select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n")
    )


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Variants among all words of ``documents``, with one occurrence in ``TYPO_EVERY`` misspelt first."""
    return variants(word_counts(docs, typo_every=TYPO_EVERY), Steps(docs.sparkSession))


# The checking engine has no crc32: a crc is the sum (xor) of what each byte contributes at its distance from the end.
CHECK = f"""
WITH RECURSIVE bits(b, c, i) AS (
  SELECT CAST(range AS BIGINT), CAST(range AS BIGINT), 0 FROM range(256)
  UNION ALL
  SELECT b, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i + 1 FROM bits WHERE i < 8),
byte_crc AS (SELECT b, c FROM bits WHERE i = 8),
far(b, k, c) AS (
  SELECT b, 0, c FROM byte_crc
  UNION ALL
  SELECT f.b, f.k + 1, xor(f.c // 256, t.c) FROM far f JOIN byte_crc t ON t.b = f.c % 256 WHERE f.k < 255),
start(k, c) AS (
  SELECT 0, CAST(4294967295 AS BIGINT)
  UNION ALL
  SELECT s.k + 1, xor(s.c // 256, t.c) FROM start s JOIN byte_crc t ON t.b = s.c % 256 WHERE s.k < 255),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[{LETTERS}]{{{MIN_CHARS},}}')) AS run
  FROM documents),
own AS (SELECT doc_id, run, count(*) AS times, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h
        FROM runs GROUP BY doc_id, run),
crcs AS (
  SELECT o.doc_id, o.run, any_value(o.times) AS times, xor(bit_xor(f.c), xor(any_value(s.c), 4294967295)) AS crc
  FROM (SELECT *, unnest(range(length(h) // 2)) AS pos FROM own) o
  JOIN far f ON f.b = CAST('0x' || substr(o.h, 2 * o.pos + 1, 2) AS INTEGER) AND f.k = length(o.h) // 2 - 1 - o.pos
  JOIN start s ON s.k = length(o.h) // 2
  GROUP BY o.doc_id, o.run),
spelt AS (
  SELECT CASE WHEN crc % {TYPO_EVERY} = 0 THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2)
              ELSE run END AS word, times FROM crcs),
words AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM spelt WHERE length(word) >= {MIN_CHARS}
          GROUP BY word HAVING sum(times) >= {MIN_COUNT}),
cuts AS (SELECT word, n, i, substr(word, 1, i) AS head, substr(word, i + 2) AS tail
         FROM (SELECT *, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON b.i = a.i AND b.head = a.head AND b.tail = a.tail AND b.word <> a.word
  UNION
  SELECT c.word, w.word, w.n FROM cuts c JOIN words w ON w.word = c.head || c.tail
  UNION
  SELECT w.word, c.word, c.n FROM cuts c JOIN words w ON w.word = c.head || c.tail),
best AS (SELECT word, count(*) AS n_near, arg_max(other, (other_n, -place)) AS form, max(other_n) AS form_n
         FROM (SELECT *, row_number() OVER (ORDER BY other) AS place FROM near) GROUP BY word),
formed AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.form_n >= {RATIO} * w.n THEN b.form END AS form,
                  CASE WHEN b.form_n >= {RATIO} * w.n THEN b.form_n END AS form_n
           FROM words w LEFT JOIN best b ON b.word = w.word),
way(word, here, onward) AS (
  SELECT word, word, form FROM formed
  UNION ALL
  SELECT y.word, f.word, f.form FROM way y JOIN formed f ON f.word = y.onward)
SELECT f.word, f.form, y.here AS root, f.n, f.n_near, f.form_n FROM formed f JOIN way y ON y.word = f.word AND y.onward IS NULL"""
