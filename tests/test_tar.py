"""SRC-2: archive members as files, readable members counted, lines numbered per member."""

import io
import json
import tarfile

from pyspark.sql import functions as F

from pagelex.sources import dump as D
from pagelex.sources.tar import read_tar_lines


def _archive(path, gz):
    mode = "w:gz" if gz else "w"
    with tarfile.open(path, mode) as tar:
        d = tarfile.TarInfo("dir")
        d.type = tarfile.DIRTYPE
        tar.addfile(d)
        for m in range(1, 4):
            body = "\n".join(json.dumps({"name": f"M{m}L{i}", "article_body": {"html": "<p/>"}}) for i in range(1, 6)) + "\n"
            info = tarfile.TarInfo(f"part{m}.ndjson")
            info.size = len(body.encode())
            tar.addfile(info, io.BytesIO(body.encode()))


def test_tar_and_targz(spark, tmp_path):
    for gz in (False, True):
        p = str(tmp_path / ("d.tar.gz" if gz else "d.tar"))
        _archive(p, gz)
        lines = read_tar_lines(spark, [p])
        rows = {(r.file_number, r.line_number): r.value for r in lines.collect()}
        assert len(rows) == 15 and json.loads(rows[(2, 3)])["name"] == "M2L3"
        sliced = lines.where((F.col("file_number") >= 2) & (F.col("file_number") <= 3)).where(D.line_range("2:2", "3:4"))
        titles = sorted(r.title for r in D.good_lines(D.decode_dump_lines(sliced)).collect())
        assert titles == ["M2L2", "M2L3", "M2L4", "M3L2", "M3L3", "M3L4"]
