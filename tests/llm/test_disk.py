"""What operators leave on the disk while they run."""

import time

from quern.llm import fingerprint


def shuffled_mb(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [files.apply(k) for k in range(files.size())]
    return sum(f.length() for f in files if f.getName().startswith("shuffle_") and f.getName().endswith(".data")) / 1e6


def test_fingerprints_shuffle_texts_one_at_a_time(spark, monkeypatch):
    """The texts dealt by doc_id have left the disk when they are dealt by digest."""
    left, compare = [], fingerprint.differing

    def seen(canon):
        ends = time.time() + 10
        while (mb := shuffled_mb(spark) - start) > 1 and time.time() < ends:
            time.sleep(0.2)
        left.append(mb)
        return compare(canon)

    monkeypatch.setattr(fingerprint, "differing", seen)
    docs = spark.range(2000).selectExpr("id as doc_id", "array_join(transform(sequence(1, 40), k -> md5(concat(id, '-', k))), ' ') as text")
    start = shuffled_mb(spark)
    table = fingerprint.fingerprints(docs)
    assert table.count() == 2000 and len(left) == 1 and left[0] < 1
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
