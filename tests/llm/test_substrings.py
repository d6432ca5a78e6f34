"""Substring dedup against a plain pass over all units."""

import hashlib
import re

import pytest

from rightsweave.llm import substrings
from rightsweave.llm.common import identified

TILE = re.compile(r"(?:[^\n.!?]+|[.!?]+[^ \t\n\v\f\r.!?])*[.!?]*[ \t\n\v\f\r]*")


def brute(rows, least=5):
    """(doc_id, unit, start, stop, digest, copies, kept_doc_id, kept_unit) of all but the first of each unit."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    seen = {}
    for i in order:
        at = 0
        for unit, m in enumerate(TILE.finditer(rows[i][1] or "")):
            body = " ".join(w for w in re.split(r"[ \t\n\v\f\r]+", m[0].lower()) if w)
            if len(body.split(" ")) >= least:
                seen.setdefault(hashlib.md5(body.encode()).hexdigest(), []).append((rows[i][0], unit, at, at + len(m[0])))
            at += len(m[0])
    return sorted(((d, u, a, b, h, len(own), own[0][0], own[0][1]) for h, own in seen.items() for d, u, a, b in own[1:]),
                  key=str)


def brute_cut(rows, least=5):
    """The texts of (doc_id, text) in order, without what a plain pass over all pieces finds again."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    seen, out = set(), [t for _, t in rows]
    for i in order:
        kept = list(rows[i][1] or "")
        for _, start, stop, digest in substrings.pieces_of(rows[i][1] or "", least):
            if digest in seen:
                kept[start:stop] = [""] * (stop - start)
            seen.add(digest)
        out[i] = rows[i][1] and "".join(kept)
    return out


def check(frame):
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    got = sorted((tuple(r) for r in substrings.repeated_units(frame).collect()), key=str)
    assert got == brute(rows)
    return rows, got


def test_all_documents(docs):
    check(docs)


def test_edge_rows(edge):
    check(edge)


def test_tiles_cover_texts(edge, docs):
    for r in [*edge.collect(), *docs.limit(100).collect()]:
        found = [m[0] for m in substrings._TILE.finditer(r.text or "")]
        assert "".join(found) == (r.text or "")


def test_passages_inside_lines_are_cut(spark):
    passage = " ".join(f"Sentence number {i} of the shared passage has enough words." for i in range(8))
    rows = [(1, f"Own words begin the first line. {passage} And the first goes on."),
            (2, f"Quite another beginning of a document here. {passage} Then something else follows."),
            (3, "Nothing of it is in the third document at all.")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in substrings.remove_repeats(frame).collect()}
    assert out[1] == rows[0][1] and out[3] == rows[2][1]
    assert out[2] == "Quite another beginning of a document here. Then something else follows."


def test_removed_texts_are_the_originals_without_their_spans(edge):
    out = substrings.remove_repeats(edge)
    assert out.columns == edge.columns and out.count() == edge.count()
    rows, row = identified(edge)
    spans = {}
    for r in substrings.repeats(rows, row).collect():
        spans.setdefault(r.row, []).append((r.start, r.stop))
    want = sorted((str(r.doc_id), substrings.cut(r.text, spans.get(r[row], []))) for r in rows.collect() if r.text is not None)
    assert sorted((str(r.doc_id), r.text) for r in out.collect() if r.text is not None) == want
    left = [w for _, t in want for w in t.split(". ") if len(w.split()) >= 5]
    assert len(left) == len({w.lower().strip(" .") for w in left})


def test_empty_table(no_docs):
    assert substrings.repeated_units(no_docs).count() == 0
    assert substrings.remove_repeats(no_docs).columns == no_docs.columns


def removed(spark, *texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in sorted(substrings.remove_repeats(frame).collect())]


def test_short_lines_and_short_sentences_are_cut(spark):
    out = removed(spark, "All rights reserved.\nThe first page has text of its own here.",
                  "Another page begins with other words here.\nall rights  reserved.",
                  "The passage starts in this place now. Well then. It goes on for some more words. Yes.",
                  "Ahead of it are other words today.\nThe passage starts in this place now. Well then. It goes on for some more words. Yes.")
    assert out[0].startswith("All rights reserved.") and out[1] == "Another page begins with other words here.\n"
    assert out[2].endswith("Yes.") and out[3] == "Ahead of it are other words today.\n"


def test_scripts_without_spaces_are_cut(spark):
    line, first, second = "".join(map(chr, range(0x4E00, 0x4E00 + 1000))), "今日は天気がとても良いです。", "明日の会議は三時から始まります。"
    out = removed(spark, line, line, f"私は昨日東京へ行きました。{first}", f"{first}{second}", "ภาษาไทยไม่มีช่องว่าง", "ภาษาไทยไม่มีช่องว่าง")
    assert out == [line, "", f"私は昨日東京へ行きました。{first}", second, "ภาษาไทยไม่มีช่องว่าง", ""]


def test_one_copy_stays(spark):
    out = removed(spark, "  same words in a single line", "no. no. no. no. no. no. no. ", "x x x x x x x. x x x x x x x.", " a\n a\nb")
    assert out == ["  same words in a single line", "no. ", "x x x x x x x. ", " a\n b"]


def test_unpunctuated_passages_inside_lines_are_cut(spark):
    passage = " ".join(f"word{i * i % 97}of{i}" for i in range(60))
    around = [" ".join(f"{side}{i}x{i * i % 13}" for i in range(20)) for side in ("before", "after", "ahead", "behind")]
    first, second = f"{around[0]} {passage} {around[1]}", f"{around[2]} {passage} {around[3]}"
    out = removed(spark, first, second)
    assert out[0] == first and out[1].startswith(around[2]) and out[1].endswith(around[3])
    assert sum(w in passage.split() for w in out[1].split()) <= 25
    # around a word that differs in a long sentence
    words = passage.split()
    out = removed(spark, passage, " ".join([*words[:30], "other", *words[31:]]))
    assert out[0] == passage and "other" in out[1] and len(out[1].split()) <= 25
    # and without spaces
    line = "".join(chr(0x4E00 + i * i * 7 % 5003) for i in range(200))
    out = removed(spark, "天地玄黄" + line + "宇宙洪荒", "日月盈昃" + line + "辰宿列张")
    assert out[1].startswith("日月盈昃") and out[1].endswith("辰宿列张") and len(out[1]) < 100


def test_long_runs_of_one_word_keep_one_copy(spark):
    out = removed(spark, "w " * 1000, "w " * 1000, "z" * 5000)
    assert out[0].split() and set(out[0].split()) == {"w"} and out[1] == "" and set(out[2]) == {"z"}


@pytest.mark.parametrize("remembered", [substrings.REMEMBERED, 50])
def test_cut_texts_against_a_plain_pass(docs, edge, monkeypatch, remembered):
    monkeypatch.setattr(substrings, "REMEMBERED", remembered)
    for frame in (docs, edge):
        rows = [(r.doc_id, r.text) for r in frame.collect()]
        got = sorted((str(r.doc_id), str(r.text)) for r in substrings.remove_repeats(frame).collect())
        assert got == sorted((str(i), str(t)) for (i, _), t in zip(rows, brute_cut(rows)))


def test_a_hot_piece_meets_once_a_task(spark):
    line = "the very same line stands in every document here\n"
    frame = spark.range(20_000).selectExpr("id as doc_id", f"concat('own words of document number ', id, ' here\n', '{line}') as text")
    rows, row = identified(frame)
    spans = substrings._spans(rows, row, 5)
    assert spans.count() == 19_999
    assert {r.text.endswith(line) for r in substrings.remove_repeats(frame).where("doc_id > 0").collect()} == {False}
