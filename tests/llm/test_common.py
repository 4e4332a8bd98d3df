import os

from matchlake.llm import common


def test_whole_file_appears_once_complete(tmp_path):
    path = f"file://{tmp_path}/a/b.bin"
    with common.whole_file(path) as out:
        out.write(b"one")
        assert not os.path.exists(f"{tmp_path}/a/b.bin")
    with common.whole_file(path) as out:        # a repeated task
        out.write(b"one")
    assert os.listdir(f"{tmp_path}/a") == ["b.bin"]
    assert open(f"{tmp_path}/a/b.bin", "rb").read() == b"one"


def test_failed_attempt_leaves_no_file(tmp_path):
    try:
        with common.whole_file(f"file://{tmp_path}/b.bin") as out:
            out.write(b"half")
            raise RuntimeError
    except RuntimeError:
        pass
    assert not os.path.exists(f"{tmp_path}/b.bin")


def test_known_small(spark):
    df = spark.range(10)
    assert "broadcast" in common.known_small(df, 10)._jdf.queryExecution().analyzed().toString().lower()
    assert common.known_small(df, 9) is df
