import os
import tempfile

from annomart.queries import cat
from annomart.streaming.id_updates import start_id_updates

SF = "/root/testdata/sf0.001"


def test_stream_id_updates(spark):
    root = tempfile.mkdtemp(prefix="annomart-stream-", dir="/tmp")
    in_dir = os.path.join(root, "in")
    os.makedirs(in_dir)
    c = cat(spark, SF)
    known = [r.uniquename for r in c["feature"].filter("uniquename like 'FBgn%' and not is_obsolete").limit(2).collect()]
    with open(os.path.join(in_dir, "a.txt"), "w") as fh:
        fh.write("\n".join(known + ["FBgn8999999", "", known[0]]) + "\n")
    q = start_id_updates(spark, c, in_dir, os.path.join(root, "out"), os.path.join(root, "ckpt"), trigger_once=True)
    q.awaitTermination(120)
    rows = spark.read.parquet(os.path.join(root, "out")).collect()
    got = sorted((r.submitted_id, r.status or "") for r in rows)
    assert got == sorted([(known[0], "current"), (known[0], "current"), (known[1], "current"), ("FBgn8999999", "")])
