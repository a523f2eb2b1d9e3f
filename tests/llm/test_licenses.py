import re
import textwrap

from ledgerline.llm import licenses
from ledgerline.llm.licenses import KNOWN, known_digests, scan


def test_whole_texts_and_lines(spark, documents):
    mit = next(text for name, text in KNOWN if name == "MIT")
    noisy = "Copyright (c) 2020 Some One\n" + mit.upper().replace(", ", " ,\n  ") + "\n\n(c) 1999 X"
    rows = [
        (1, mit), (2, noisy), (3, mit + " and more"), (4, None), (5, ""), (6, "..."),
        (7, "Some text.\nlicenced under the APACHE Licence -- version 2.0\nmore\nReleased under the MIT License."),
        (1, mit), (8, "word " * 200_000),
    ]
    got = {}
    for r in scan(documents(rows), known_digests(spark)).collect():
        got.setdefault(r.doc_id, []).append((r.license, r.notices, r.n_notices))
    assert got[1] == [("MIT", "MIT", 1)] * 2
    assert got[2][0][0] == "MIT" and got[3] == [(None, None, 0)]
    assert got[4] == got[5] == got[6] == got[8] == [(None, None, 0)]
    assert got[7] == [(None, "Apache-2.0,MIT", 2)]


def test_rows_of_one_id_and_of_none(spark, documents):
    """Every row has its own notices, whatever its id."""
    rows = [(None, "Released under the MIT License."), (None, "nothing"), (5, "Licensed under CC0 1.0.\nx"), (5, "no notice"), (5, None)]
    got = sorted((r.doc_id is not None, r.notices or "", r.n_notices) for r in scan(documents(rows), known_digests(spark)).collect())
    assert got == [(False, "", 0), (False, "MIT", 1), (True, "", 0), (True, "", 0), (True, "CC0-1.0", 1)]


def test_every_known_text_is_found_in_other_spellings(spark, documents):
    """Whole texts and headers, wrapped, in capitals, with a copyright line before them."""
    wrapped = lambda text: "Copyright 2001 A. Body\n\n" + "\n".join(textwrap.wrap(re.sub(r"\bLICENSE\b", "LICENCE", text.upper()), 60))
    rows = [(i, wrapped(text)) for i, (_, text) in enumerate(KNOWN)]
    got = {r.doc_id: r.license for r in scan(documents(rows), known_digests(spark)).collect()}
    assert got == {i: name for i, (name, _) in enumerate(KNOWN)}


def test_empty_table(spark, documents):
    assert scan(documents([]), known_digests(spark)).collect() == []


def test_canonical_is_stable(spark):
    df = spark.createDataFrame([("The  Licence,\tcentre: http://x",)], "t STRING")
    form = df.select(licenses.canonical(df.t)).first()[0]
    assert form == "the license center https x"
    again = spark.createDataFrame([(form,)], "t STRING")
    assert again.select(licenses.canonical(again.t)).first()[0] == form
