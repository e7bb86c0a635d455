"""The streaming statistics equal the batch operator on the same rows."""

import tempfile
import uuid

from pyspark.sql import functions as F

from itemscope.operators import features as FE
from itemscope.operators.clean import clean_interactions
from itemscope.sources import fixtures as FX
from itemscope.streaming.incremental import latest_stats, start_rating_stats

from conftest import SF001


def test_stream_matches_batch(spark):
    src = tempfile.mkdtemp(prefix="itemscope-src-")
    out = tempfile.mkdtemp(prefix="itemscope-out-")
    ratings = FX.ratings(spark, SF001)
    # two arrivals: the stream must accumulate across files
    ratings.filter(F.col("userId") % 2 == 0).write.mode("append").parquet(src)
    name, ckpt = f"t_stream_{uuid.uuid4().hex}", tempfile.mkdtemp(prefix="itemscope-stream-")
    q = start_rating_stats(spark, src, out, ckpt, name=name)
    q.awaitTermination()
    ratings.filter(F.col("userId") % 2 == 1).write.mode("append").parquet(src)
    q = start_rating_stats(spark, src, out, ckpt, name=name)
    q.awaitTermination()
    got = {r.movieId: r for r in latest_stats(spark, out).collect()}
    want = {r.movieId: r for r in FE.rating_stats(clean_interactions(ratings)).collect()}
    assert set(got) == set(want)
    for k, w in want.items():
        g = got[k]
        assert g.rating_count == w.rating_count and g.min_rating == w.min_rating
        assert abs(g.avg_rating - w.avg_rating) < 1e-9 and g.last_rating_ts == w.last_rating_ts
        assert (g.rating_std is None and w.rating_std is None) or abs(g.rating_std - w.rating_std) < 1e-9
