import pytest

from matchlake import session
from matchlake.sources import catalog as C
from matchlake.sources import files as FS


class FakeContext:
    def __init__(self, master):
        self.master, self.dir = master, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class FakeSpark:
    def __init__(self, master, conf=None):
        self.sparkContext = FakeContext(master)
        self.conf = type("C", (), {"get": lambda _, k, d=None: (conf or {}).get(k, d)})()


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError):
        session.shared_dir(FakeSpark(master), "x")
    shared = FakeSpark(master, {"spark.checkpoint.dir": "hdfs://n/ck"})
    assert session.shared_dir(shared, "a", "b").startswith("hdfs://n/ck/a/b-")
    assert session.ensure_checkpoint_dir(shared) == "hdfs://n/ck"


def test_a_local_master_makes_its_own():
    spark = FakeSpark("local[2]")
    assert session.shared_dir(spark, "x").startswith(session.ensure_checkpoint_dir(spark))


def test_use_schema(spark, tmpdir_path):
    C.ensure_schemas(spark, "used")
    C.replace_table(spark, "used.t", spark.range(3), f"{tmpdir_path}/t/v1")
    C.use_schema(spark, "used")
    try:
        assert spark.table("t").count() == 3
    finally:
        C.use_schema(spark, "default")


def test_csv_types_fit_all_rows(spark, tmpdir_path):
    with open(f"{tmpdir_path}/a_WL_tagged.csv", "w") as f:
        f.write("v\n" + "1\n" * 5000 + "not a number\n")
    df = FS.read_ladder_csv(spark, tmpdir_path)
    assert dict(df.dtypes) == {"v": "string"} and df.count() == 5001
