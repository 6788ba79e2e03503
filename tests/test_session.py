"""Session settings and the shared folder."""

from touchline.session import configure, work_dir


def test_scratch_folders_are_fresh_and_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = work_dir(spark, "x"), work_dir(spark, "x")
    assert one != two and one.startswith(f"{shared}/x-") and two.startswith(f"{shared}/x-")


def test_configure_sets_what_results_depend_on(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    assert configure(spark).conf.get("spark.sql.session.timeZone") == "UTC"
