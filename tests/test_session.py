from __future__ import annotations

import os

from ebbline.session import run_folder, ship, work_dir, write_table


def test_a_run_folder_takes_the_intermediates_and_goes(spark):
    outside = work_dir(spark)
    with run_folder(spark) as folder:
        assert work_dir(spark) == folder and folder.startswith(outside.rstrip("/"))
        assert write_table(spark.range(3), "numbers").count() == 3
        path = folder.removeprefix("file:")
        assert os.listdir(path)
        with run_folder(spark) as inner:
            assert inner.startswith(folder)
        assert work_dir(spark) == folder
    assert not os.path.exists(path) and work_dir(spark) == outside


def test_the_package_is_sent_to_the_workers(spark):
    ship(spark)
    ship(spark)

    def where(batches):
        import pandas as pd

        from ebbline import schema

        yield pd.DataFrame({"n": [len(schema.FEATURES)]})

    assert spark.range(1).mapInPandas(where, "n long").first().n == 33
