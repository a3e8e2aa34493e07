"""Each stage of the pipeline, on its own input, against brute force."""

import re

import corpus_pipeline as CP
from waitline.llm import common as C
from waitline.llm import packing, substring

from test_mixing import brute as mixed
from test_packing import check as packed
from test_quality import brute as base
from test_simhash import brute_components, brute_print
from test_substring import brute as cut

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.select("doc_id", "text", "lang", "source", "n_chars").collect()))


def test_stages(spark):
    at = [C.table(spark, SF, "documents")]
    for name, stage in CP.STAGES:
        at.append(C.stored(stage(spark, at[-1], SF), "test"))
    assert [x.columns for x in at[1:-1]] == [at[0].columns] * 4
    every, good, single, short, repeated = map(rows, at[:5])

    from waitline.llm import quality

    verdict = {r.id: r.kept for r in quality.judged(at[0]).collect()}
    assert good == [r for r in every if verdict[r[0]]]
    assert not [r for r in good if base(r[1])[-1]] and len(good) > 0.7 * len(every)

    parts = brute_components([brute_print(r[1]) for r in good], [r[0] for r in good])
    assert single == [r for r, c in zip(good, parts) if r[0] == c] and len(single) < len(good)

    want = cut([r[:2] for r in single])
    assert [r[0] for r in short] == [w[0] for w in want]
    digests = [(len(re.findall(r"[^\x20\x09-\x0D]+", r[1])),) for r in short]
    assert [n for (n,) in digests] == [w[1] - w[2] for w in want] and any(w[2] for w in want)
    assert all(a == b for a, b, w in zip(single, short, want) if not w[2])
    assert all(r[4] == len(r[1]) for r in short)

    copies = mixed([(r[0], r[1], r[3]) for r in short])
    assert sorted(r[0] for r in repeated) == sorted(c[0] for c in copies)
    assert set(repeated) <= set(short)

    n = packed(at[5].collect(), [r[:2] for r in repeated], packing.SIZE)
    assert n <= -(-sum(r.length for r in at[5].collect()) // packing.SIZE) + 1
    assert substring.WIDTH == 13


def test_run(spark):
    assert CP.run(spark, SF).count() > 0
