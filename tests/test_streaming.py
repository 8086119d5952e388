import numpy as np

from strataloom.functions.grid import Affine
from strataloom.sources import tiff
from strataloom.streaming import watch_tiles


def test_new_tiles_once(spark, tmp_path):
    folder, done = tmp_path / "in", []
    folder.mkdir()

    def handle(batch, _):
        done.extend(r["raster_id"] for r in tiff.metadata(batch).collect())

    for names in (["a", "b", "c"], ["d"], []):
        for n in names:
            (folder / f"{n}.tif").write_bytes(tiff.write(np.ones((2, 2), np.int16), tiff.Profile("int16", Affine.from_origin(0, 2, 1, 1))))
        watch_tiles(spark, str(folder), str(tmp_path / "cp"), handle, per_batch=2).awaitTermination()
    assert sorted(done) == ["a", "b", "c", "d"]
