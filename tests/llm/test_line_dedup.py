from collections import defaultdict

from helpers import CLASHING, frame
from ticklake.llm.line_dedup import deduplicated


def brute(rows):
    seen, gone = set(), defaultdict(set)
    for i, text in sorted(rows, key=lambda r: r[0]):
        lines = (text or "").split("\n")
        solid = [k for k, x in enumerate(lines) if x.strip(" ")]
        for a in range(len(solid) - 2):
            window = tuple(lines[k].strip(" ") for k in solid[a : a + 3])
            if window in seen:
                gone[i].update(solid[a : a + 3])
            seen.add(window)
    out = {}
    for i, text in rows:
        lines = (text or "").split("\n")
        out[i] = ("\n".join(x for k, x in enumerate(lines) if k not in gone[i]), sum(bool(x.strip(" ")) for x in lines), len(gone[i]))
    return out


ROWS = [
    (1, "a\nb\nc\nd"), (2, "x\na\n\n b \nc\ny"), (3, "b\nc\nd\na\nb\nc"), (4, None), (5, ""), (6, "a\nb"), (7, "q\nq\nq\nq\nq"), (8, "q\nq\nq"), (9, "\n\n\n"),
    (10, "\n".join(f"l{k % 700}" for k in range(3000))),
]


def test_like_plain_scan(spark):
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in deduplicated(frame(spark, ROWS, CLASHING)).collect()}
    assert got == brute(ROWS)


def test_empty_table_null_ids_and_repeated_rows(spark):
    assert deduplicated(frame(spark, [])).collect() == []
    got = deduplicated(frame(spark, [(None, "a\nb\nc"), (1, "a\nb\nc"), (2, "u\nv\nw"), (2, "u\nv\nw")])).collect()
    assert {(r["doc_id"], r["text"]) for r in got} >= {(None, ""), (1, "a\nb\nc")} and len(got) == 4
