import os
import tempfile

from pyspark.sql import functions as F

from waitline import schemas
from waitline.sources import dump, files


def _tmp():
    return tempfile.mkdtemp(prefix="waitline-test-")


XML = """<?xml version="1.0" encoding="utf-8"?>
<posts>
  <row Id="1" PostTypeId="1" CreationDate="2016-02-01T10:00:00.000" Body="&lt;p&gt;hi&lt;/p&gt;" Tags="&lt;c#&gt;" />
  <row Id="2" PostTypeId="2" ParentID="1" CreationDate="2016-02-01T10:05:00.123" Extra="x" />
  <row Id="abc" PostTypeId="1" CreationDate="2016-02-01T10:00:00" />
  <row PostTypeId="1" />
</posts>
"""


def test_xml_dump_types_and_quarantine(spark):
    d = _tmp()
    p = os.path.join(d, "posts.xml")
    with open(p, "w") as f:
        f.write(XML)
    good, bad = dump.read_dump(spark, p, "posts")
    rows = {r.id: r for r in good.collect()}
    assert set(rows) == {1, 2}
    assert rows[2].parentid == 1  # ParentID matched regardless of case
    assert rows[1].body == "<p>hi</p>" and rows[1].tags == "<c#>"
    assert str(rows[2].creationdate) == "2016-02-01 10:05:00.123000"
    reasons = sorted(r.reason for r in bad.collect())
    assert reasons == ["bad value: id", "missing key"]
    assert good.schema == schemas.struct("posts")


def test_csv_with_quoted_multiline(spark):
    d = _tmp()
    p = os.path.join(d, "posts.csv")
    with open(p, "w") as f:
        f.write('Id,ParentId,CreationDate,Body\n1,,2016-05-01T10:00:00,"a\nb, ""c"""\n2,1,2016-05-01T11:00:00,x\n')
    from pyspark.sql import types as T

    schema = T.StructType([
        T.StructField("Id", T.LongType()), T.StructField("ParentId", T.LongType()),
        T.StructField("CreationDate", T.TimestampNTZType()), T.StructField("Body", T.StringType()),
    ])
    df = files.read_csv(spark, p, schema)
    rows = {r.Id: r for r in df.collect()}
    assert rows[1].Body == 'a\nb, "c"' and rows[1].ParentId is None and rows[2].ParentId == 1


def test_json_round_trip_and_stage_partitions(spark):
    d = _tmp()
    df = spark.createDataFrame(
        [(1, "a b", 10)], "id bigint, badges string, userid bigint"
    ).select("badges", "userid", "id")
    files.write_json(df, f"{d}/earned")
    back = files.read_json(spark, f"{d}/earned", schemas.stage_struct("earned_badges"))
    assert [tuple(r) for r in back.collect()] == [("a b", 10, 1)]
    files.write_stage(df, f"{d}/stage", "2016-02-01")
    files.write_stage(df.withColumn("id", F.lit(2).cast("bigint")), f"{d}/stage", "2015-11-01")
    files.write_stage(df.withColumn("id", F.lit(3).cast("bigint")), f"{d}/stage", "2016-02-01")
    got = files.read_stage(spark, f"{d}/stage", "2016-02-01").collect()
    assert [r.id for r in got] == [3]  # one date overwritten, the other kept
    assert [r.id for r in files.read_stage(spark, f"{d}/stage", "2015-11-01").collect()] == [2]
    files.append_table(df, f"{d}/appended")
    files.append_table(df, f"{d}/appended")
    assert spark.read.parquet(f"{d}/appended").count() == 2


def test_model_save_and_load(spark):
    from waitline.plans import models as MD

    d = _tmp()
    df = spark.createDataFrame(
        [(i, f"word{i % 3} common text{i % 5}", float(i % 2)) for i in range(40)],
        "id bigint, text string, label double",
    )
    spec = MD.ModelSpec("t", {"text": MD.TextBlock("text")}, MD.logistic(1.0, 40), svd_k=3)
    m = spec.pipeline().fit(df)
    MD.save_model(m, f"{d}/model")
    again = MD.load_model(f"{d}/model")
    a = [r.prediction for r in m.transform(df).orderBy("id").collect()]
    b = [r.prediction for r in again.transform(df).orderBy("id").collect()]
    assert a == b


def test_svd_matches_numpy(spark):
    import numpy as np
    from pyspark.ml.functions import array_to_vector, vector_to_array

    from waitline.plans import models as MD

    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    x = np.array([r.embedding for r in e.orderBy("vec_id").collect()], dtype=np.float64)
    v = e.select("vec_id", array_to_vector("embedding").alias("v"))
    m = MD.TruncatedSvd("v", "p", 4, algorithm="exact").fit(v)
    got = np.array([r.p for r in m.transform(v).orderBy("vec_id").select(vector_to_array("p").alias("p")).collect()])
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    # flat spectrum: captured energy is near the optimum
    assert (got ** 2).sum() / (s[:4] ** 2).sum() > 0.98
    # decaying spectrum: the components themselves are recovered
    rng = np.random.default_rng(0)
    u0 = np.linalg.qr(rng.standard_normal((300, 6)))[0]
    v0 = np.linalg.qr(rng.standard_normal((40, 6)))[0]
    y = u0 @ np.diag([50, 30, 20, 10, 5, 2.0]) @ v0.T + 0.01 * rng.standard_normal((300, 40))
    ydf = spark.createDataFrame([(i, y[i].tolist()) for i in range(300)], "i int, a array<double>")
    ydf = ydf.select("i", array_to_vector("a").alias("v"))
    m2 = MD.TruncatedSvd("v", "p", 3, algorithm="exact").fit(ydf)
    got2 = np.array([r.p for r in m2.transform(ydf).orderBy("i").select(vector_to_array("p").alias("p")).collect()])
    _, _, vt2 = np.linalg.svd(y, full_matrices=False)
    want2 = y @ vt2[:3].T
    for j in range(3):
        assert abs(np.corrcoef(got2[:, j], want2[:, j])[0, 1]) > 0.9999


def test_randomized_svd_path(spark, monkeypatch):
    import numpy as np
    from pyspark.ml.functions import array_to_vector, vector_to_array

    from waitline.plans import models as MD

    rng = np.random.default_rng(1)
    u0 = np.linalg.qr(rng.standard_normal((300, 5)))[0]
    v0 = np.linalg.qr(rng.standard_normal((60, 5)))[0]
    y = u0 @ np.diag([40, 20, 10, 5, 1.0]) @ v0.T
    df = spark.createDataFrame([(i, y[i].tolist()) for i in range(300)], "i int, a array<double>")
    df = df.select("i", array_to_vector("a").alias("v"))
    got = np.array([r.p for r in MD.TruncatedSvd("v", "p", 3).fit(df).transform(df)
                    .orderBy("i").select(vector_to_array("p").alias("p")).collect()])
    _, _, vt = np.linalg.svd(y, full_matrices=False)
    want = y @ vt[:3].T
    for j in range(3):
        assert abs(np.corrcoef(got[:, j], want[:, j])[0, 1]) > 0.9999


def test_lemma_model_save_and_load(spark):
    from waitline.plans import models as MD

    d = _tmp()
    df = spark.createDataFrame(
        [(i, f"cat cats dog{'s' * (i % 2)} box boxes word{i % 3}", float(i % 2)) for i in range(40)],
        "id bigint, text string, label double",
    )
    spec = MD.ModelSpec("t", {"text": MD.TextBlock("text", "lemmas")}, MD.logistic(1.0, 40))
    m = spec.pipeline().fit(df)
    MD.save_model(m, f"{d}/model")
    again = MD.load_model(f"{d}/model")
    a = [r.prediction for r in m.transform(df).orderBy("id").collect()]
    b = [r.prediction for r in again.transform(df).orderBy("id").collect()]
    assert a == b
    tokens = again.stages[1].transform(again.stages[0].transform(df)).first()
    assert "cats" not in tokens[again.stages[1].outputCol]


def test_stage_rerun_without_rows_clears_its_date(spark):
    d = _tmp()
    df = spark.createDataFrame([(1, "a")], "id bigint, name string")
    files.write_stage(df, f"{d}/stage", "2016-02-01")
    files.write_stage(df, f"{d}/stage", "2016-02-02")
    files.write_stage(df.limit(0), f"{d}/stage", "2016-02-01")
    assert files.read_stage(spark, f"{d}/stage", "2016-02-01", schema=df.schema).count() == 0
    assert files.read_stage(spark, f"{d}/stage", "2016-02-02", schema=df.schema).count() == 1
    assert files.read_stage(spark, f"file://{d}/stage", "2016-02-02").columns == df.columns


def test_numeric_entities(spark):
    from waitline.functions.html import decode_entities

    df = spark.createDataFrame([("&#65;&#x42;&#8217; &#38;lt; &amp;#65; &#0;&#xD800; &#128578;&#x1F642; &lt;",)], "t string")
    got = df.select(decode_entities("t").alias("t")).first().t
    assert got == "AB’ &lt; &#65; &#0;&#xD800; \U0001f642\U0001f642 <"


def test_badge_success_normalises_between_svd_and_forest():
    from pyspark.ml.feature import Normalizer

    from waitline.plans import models as MD
    from waitline.plans.variants import VARIANTS

    stages = VARIANTS["badge_success"].feature_stages({"badges.min_df": 2, "svd_k": 8})
    assert isinstance(stages[-1], Normalizer) and isinstance(stages[-2], MD.TruncatedSvd)
    assert "combined_forest_time" in VARIANTS
