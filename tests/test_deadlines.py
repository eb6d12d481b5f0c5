import datetime as dt


from stratum.streaming import deadlines


def t(day, hour):
    return dt.datetime(2024, 1, day, hour)


def due(source, day, market="USA"):
    return ("due", source, market, f"day {day}", t(day, 0), t(day, 6), t(day + 1, 0))


def file(source, day, hour, market="USA"):
    return ("file", source, market, f"day {day}", t(day, hour), None, None)


def run(spark, tmp_dir, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, deadlines.INPUT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
        deadlines.watch_folder(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt", "1 day").awaitTermination()
    return sorted(tuple(r)[0:1] + (int(r.period[4:]), r.status, r.delivered_at and r.delivered_at.hour)
                  for r in spark.read.schema(deadlines.OUTPUT_SCHEMA).parquet(f"{tmp_dir}/out").collect())


def test_missed_late_and_absent(spark, tmp_dir):
    got = run(spark, tmp_dir, [
        [due("on_time", 1), due("late", 1), due("absent", 1), file("on_time", 1, 5), file("late", 1, 9), file("late", 1, 8)],
        [file("other", 3, 12), due("other", 3)],
        [file("other", 9, 0)],
    ])
    assert got == [("absent", 1, "absent", None), ("absent", 1, "missed", None), ("late", 1, "late", 8), ("late", 1, "missed", None),
                   ("other", 3, "late", 12), ("other", 3, "missed", None)]


def test_a_late_file_within_the_delay_counts(spark, tmp_dir):
    """A file from before the deadline comes after one from behind it."""
    got = run(spark, tmp_dir, [
        [due("a", 1), file("a", 1, 20), file("x", 1, 22)],
        [file("a", 1, 5)],
        [file("x", 9, 0)],
    ])
    assert got == []


