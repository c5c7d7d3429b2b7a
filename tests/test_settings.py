from aeroledger import settings

TB = 2**40


def test_small_input_keeps_the_cores_busy():
    got = settings.settings_for(10 * settings.MB, 8)
    assert got["spark.sql.shuffle.partitions"] == "8"
    assert got["spark.sql.files.maxPartitionBytes"] == str(128 * settings.MB)


def test_no_task_grows_without_bound():
    assert settings.shuffle_partitions(TB // 8) == 3072
    for size in (TB, 10 * TB, 100 * TB, 1000 * TB):
        got = settings.settings_for(size, 4000)
        assert int(got["spark.sql.files.maxPartitionBytes"]) <= 1024 * settings.MB
        assert int(got["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) <= 1024 * settings.MB
        assert 3 * size / int(got["spark.sql.shuffle.partitions"]) <= 1024 * settings.MB
