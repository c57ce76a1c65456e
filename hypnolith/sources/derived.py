"""Sleep tables derived from the ``events`` and ``customer`` tables.

Each user and week of a month makes one recording; each event makes one
annotation, with a week of wall-clock time scaled to 8.4 hours of sleep. Ids and
names hold every user, month and week: none is shortened or folded onto another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hypnolith.functions.keys import lookup_by_salted_key
from hypnolith.functions.times import date_text, micros, time_text, utc_time

# Periods (weeks of months since 1970) per user in a recording's id.
PERIODS = 100_000
# Subjects that two letters and four digits tell apart, and the place of the letters SC.
SUBJECTS = 6_760_000
FIRST_LETTERS = 18 * 26 + 2


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _timed(events: DataFrame) -> DataFrame:
    timed = events.select(
        "event_id", "event_type", utc_time(events, "ts").alias("ts"), "user_id"
    )
    month = (F.year("ts") - 1970) * 12 + F.month("ts") - 1
    week = F.floor((F.dayofmonth("ts") - 1) / 7)
    return timed.select(
        "*", (month * 5 + week).alias("period"), micros(F.col("ts")).alias("us")
    ).withColumn("rec_id", F.col("user_id") * PERIODS + F.col("period"))


def _padded(number: Column, width: int) -> Column:
    """Digits with zeros before them up to ``width``; longer numbers stay whole."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def _patient_code(user: str):
    return F.concat(F.lit("SC"), _padded(F.col(user), 6))


def patients(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    return customer.select(
        key.alias("patients_id"),
        _patient_code("c_custkey").alias("patients_code"),
        F.when(key % 4 != 0, 18 + key % 63).cast("int").alias("age"),
        F.when(key % 5 == 0, F.lit(None))
        .when(key % 2 == 1, F.lit("F"))
        .otherwise(F.lit("M"))
        .alias("sex"),
        F.when(key % 6 != 0, 18 + key % 17).cast("int").alias("bmi"),
    )


def recordings(events: DataFrame) -> DataFrame:
    started = _timed(events).groupBy("user_id", "period", "rec_id").agg(F.min("ts").alias("first_ts"))
    code = _patient_code("user_id")
    rec_code = F.concat(F.lit("E"), F.col("period").cast("string"))
    return started.select(
        "rec_id",
        F.col("user_id").alias("patients_id"),
        rec_code.alias("rec_code"),
        F.concat(code, rec_code, F.lit("-PSG.edf")).alias("psg_filename"),
        F.concat(code, F.lit("EC-Hypnogram.edf")).alias("hyp_filename"),
        date_text(F.col("first_ts")).alias("rec_date"),
        time_text(F.col("first_ts")).alias("rec_log"),
    )


def notes(recordings: DataFrame) -> DataFrame:
    rec = F.col("rec_id")
    return recordings.filter(rec % 7 != 0).select(
        "rec_id",
        (rec % 3 == 0).cast("int").alias("had_coffee"),
        (rec % 5 == 0).cast("int").alias("had_alcohol"),
        (rec % 11 == 0).cast("int").alias("has_pain"),
        (rec % 4 == 1).cast("int").alias("sleep_deprived"),
        (rec % 6 == 2).cast("int").alias("stress"),
    )


def annotations(events: DataFrame) -> DataFrame:
    timed = _timed(events)
    started = timed.groupBy("rec_id").agg(F.min("us").alias("first_us"))
    event, kind = F.col("event_id"), F.col("event_type")
    text = (
        F.when(kind == "view", "Sleep stage W")
        .when(kind == "click", "Sleep stage 1")
        .when((kind == "purchase") & (event % 3 == 0), "Sleep stage 4")
        .when(kind == "purchase", "Sleep stage 2")
        .when(kind == "signup", "Sleep stage R")
        .when((kind == "error") & (event % 8 == 0), "Movement time")
        .when((kind == "error") & (event % 8 == 1), "Sleep stage ?")
        .when((kind == "error") & (event % 8 == 2), "Lights off")
        .when(kind == "error", "Sleep stage 3")
    )
    return lookup_by_salted_key(timed, started, "rec_id", "event_id").select(
        "rec_id",
        event.alias("ann_seq"),
        ((F.col("us") - F.col("first_us")).cast("double") / F.lit(20000000.0)).alias("onset"),
        F.when(event % 10 == 3, 45.0).otherwise(0.0).alias("duration"),
        text.alias("description"),
    )


def file_manifest(events: DataFrame) -> DataFrame:
    """File names of raw-data folders, with header and modification times.

    Names have room for two letters, four digits and two recordings: two weeks of one
    month share a folder, and so do users with one number beyond the 6.76 million that
    letters and digits tell apart.
    """
    user, place = F.col("user_id"), F.floor(F.col("period") / 2)
    folder = F.concat_ws(
        "-", _padded(place, 4), F.when(user >= SUBJECTS, F.expr(f"user_id div {SUBJECTS}").cast("string"))
    )
    weeks = (
        _timed(events)
        .groupBy("user_id", "period")
        .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
        .withColumn("folder", folder)
    )
    letters = F.expr(f"{FIRST_LETTERS} + user_id div 10000") % 676
    subject = F.concat(
        F.chr(65 + F.floor(letters / 26)), F.chr(65 + letters % 26), _padded(user % 10000, 4)
    )
    parity = (F.col("period") % 2).cast("string")
    psg = weeks.filter("user_id % 50 <> 7").select(
        "folder",
        F.concat(subject, F.lit("E"), parity, F.lit("-PSG.edf")).alias("name"),
        F.when(user % 3 != 0, F.col("first_ts")).alias("meas_date"),
        F.col("last_ts").alias("modified"),
    )
    per_user = weeks.groupBy("user_id", "folder").agg(
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts")
    )
    odd = per_user.filter("user_id % 50 = 7").select(
        "folder",
        F.concat(subject, F.lit("E9-PSG.edf")).alias("name"),
        F.when(user % 3 != 0, F.col("first_ts")).alias("meas_date"),
        F.col("last_ts").alias("modified"),
    )
    codes = (
        F.when(user % 5 == 0, F.array(F.lit("EC"), F.lit("EH")))
        .when(user % 5 == 1, F.array(F.lit("EC")))
        .when(user % 5 == 2, F.array(F.lit("EA"), F.lit("EB")))
        .when(user % 5 == 4, F.array(F.lit("EC"), F.lit("EH")))
    )
    hyp = (
        per_user.select("user_id", "folder", "last_ts", F.explode(codes).alias("code"))
        .withColumn("stem", F.concat(subject, F.col("code")))
        .select(
            "folder",
            F.concat(
                F.when(user % 5 == 4, F.lower("stem")).otherwise(F.col("stem")),
                F.lit("-Hypnogram.edf"),
            ).alias("name"),
            F.lit(None).cast("timestamp_ntz").alias("meas_date"),
            F.col("last_ts").alias("modified"),
        )
    )
    return psg.unionByName(odd).unionByName(hyp)


def unstaged(annotations: DataFrame) -> DataFrame:
    """Annotations with every thirteenth recording left without staging."""
    text = F.when(F.col("rec_id") % 13 == 0, "Lights off").otherwise(F.col("description"))
    return annotations.withColumn("description", text)


def found_hypnograms(recordings: DataFrame) -> DataFrame:
    """Hypnogram names present on disk: all but those of every ninth patient."""
    return recordings.filter("patients_id % 9 <> 0").select(F.col("hyp_filename").alias("name"))


# --- variants with faults, and earlier states of the tables ------------------


def patients_bad(patients: DataFrame) -> DataFrame:
    key = F.col("patients_id")
    return patients.select(
        "patients_id",
        F.when(key % 149 == 0, F.lit("SC000001"))
        .otherwise(F.col("patients_code"))
        .alias("patients_code"),
        F.when(key % 101 == 1, 16).otherwise(F.col("age")).alias("age"),
        F.when(key % 7 == 1, "male").when(key % 103 == 2, "x").otherwise(F.col("sex")).alias("sex"),
        F.when(key % 107 == 3, 71).otherwise(F.col("bmi")).alias("bmi"),
    )


def epochs_bad(epochs: DataFrame) -> DataFrame:
    index = F.col("epoch_idx")
    bad = epochs.select(
        "rec_id",
        "epoch_idx",
        "start_sec",
        F.when(index % 89 != 0, F.col("duration_sec")).alias("duration_sec"),
        F.when(index % 997 == 1, F.lit(None))
        .when(index % 991 == 2, F.lit("N4"))
        .otherwise(F.col("stage_label"))
        .alias("stage_label"),
    )
    copies = F.concat(
        F.array(F.col("rec_id")),
        F.when((index == 0) & (F.col("rec_id") % 50 == 0), F.array(F.col("rec_id"))).otherwise(
            F.array().cast("array<bigint>")
        ),
        F.when(
            (index == 0) & (F.col("rec_id") % 97 == 0), F.array(-1 - F.col("rec_id"))
        ).otherwise(F.array().cast("array<bigint>")),
    )
    return bad.withColumn("rec_id", F.explode(copies))


def notes_bad(notes: DataFrame) -> DataFrame:
    rec = F.col("rec_id")
    bad = notes.withColumn("had_coffee", F.when(rec % 13 == 0, 2).otherwise(F.col("had_coffee")))
    bad = bad.withColumn("stress", F.when(rec % 17 != 0, F.col("stress")))
    ids = F.when(rec % 97 == 0, F.array(rec, -1 - rec)).otherwise(F.array(rec))
    return bad.withColumn("rec_id", F.explode(ids))


def patients_old(patients: DataFrame) -> DataFrame:
    return patients.filter("patients_id % 2 = 0")


def recordings_old(recordings: DataFrame) -> DataFrame:
    return recordings.filter("rec_id % 4 = 0").withColumn("psg_filename", F.lit("old.edf"))


def epochs_old(epochs: DataFrame) -> DataFrame:
    return epochs.withColumn("stage_label", F.lit("W"))
