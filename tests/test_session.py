from tagloom.session import settings


def test_partitions_follow_the_input():
    assert "spark.sql.shuffle.partitions" not in settings()
    assert settings(10)["spark.sql.shuffle.partitions"] == "200"
    assert settings(100 * 2**40)["spark.sql.shuffle.partitions"] == str(400 * 1024)


def test_spark_knows_the_settings(spark):
    for name, value in settings(1).items():
        spark.newSession().conf.set(name, value)
