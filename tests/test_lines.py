"""Places of lines over several files and blocks."""

from hintforge.sources import features, sequences


def test_places_follow_names_of_files(spark, tmp_path):
    # tasks read files by falling size: the first one by name is the smallest
    want = []
    for i in range(6):
        some = [f"g{i}_{k} p" for k in range(1 + 40 * i)]
        (tmp_path / f"part-{i:05}.txt").write_text("\n".join(some) + "\n")
        want += some
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (before, "100"):  # whole files, several in a task; a file in several blocks
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert [r.line for r in features.numbered_lines(spark, str(tmp_path)).orderBy("ordinal").collect()] == want
            got = sequences.read_pairs(spark, str(tmp_path)).orderBy("ordinal").collect()
            assert [f"{r.gene} {r.prot}" for r in got] == want and len({r.ordinal for r in got}) == len(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
