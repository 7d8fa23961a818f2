"""Data model: the sensor-series schema and the cohort feature lists."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    ByteType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Names and types of the sensor series.
SERIES_SCHEMA = StructType(
    [
        StructField("step", LongType()),
        StructField("X", FloatType()),
        StructField("Y", FloatType()),
        StructField("Z", FloatType()),
        StructField("enmo", FloatType()),
        StructField("anglez", FloatType()),
        StructField("non_wear_flag", FloatType()),
        StructField("light", FloatType()),
        StructField("battery_voltage", FloatType()),
        StructField("time_of_day", LongType()),
        StructField("weekday", IntegerType()),
        StructField("quarter", IntegerType()),
        StructField("relative_date_PCIAT", FloatType()),
        StructField("id", StringType()),
    ]
)

# The stored table keeps weekday and quarter in one byte each and requires a key.
SERIES_TABLE_SCHEMA = StructType(
    [
        StructField(f.name, ByteType() if f.name in ("weekday", "quarter") else f.dataType, f.name != "id")
        for f in SERIES_SCHEMA
    ]
)

# Spelling used inside the sensor files -> column name used everywhere else.
SERIES_FILE_NAMES = {"non-wear_flag": "non_wear_flag"}

# The study's numeric columns, in dictionary order.
NUMERIC = (
    "Basic_Demos-Age",
    "CGAS-CGAS_Score",
    "Physical-BMI",
    "Physical-Height",
    "Physical-Weight",
    "Physical-Waist_Circumference",
    "Physical-Diastolic_BP",
    "Physical-HeartRate",
    "Physical-Systolic_BP",
    "Fitness_Endurance-Max_Stage",
    "Fitness_Endurance-Time_Mins",
    "Fitness_Endurance-Time_Sec",
    "FGC-FGC_CU",
    "FGC-FGC_CU_Zone",
    "FGC-FGC_GSND",
    "FGC-FGC_GSND_Zone",
    "FGC-FGC_GSD",
    "FGC-FGC_GSD_Zone",
    "FGC-FGC_PU",
    "FGC-FGC_PU_Zone",
    "FGC-FGC_SRL",
    "FGC-FGC_SRL_Zone",
    "FGC-FGC_SRR",
    "FGC-FGC_SRR_Zone",
    "FGC-FGC_TL",
    "FGC-FGC_TL_Zone",
    "BIA-BIA_Activity_Level_num",
    "BIA-BIA_BMC",
    "BIA-BIA_BMI",
    "BIA-BIA_BMR",
    "BIA-BIA_DEE",
    "BIA-BIA_ECW",
    "BIA-BIA_FFM",
    "BIA-BIA_FFMI",
    "BIA-BIA_FMI",
    "BIA-BIA_Fat",
    "BIA-BIA_Frame_num",
    "BIA-BIA_ICW",
    "BIA-BIA_LDM",
    "BIA-BIA_LST",
    "BIA-BIA_SMM",
    "BIA-BIA_TBW",
    "PAQ_A-PAQ_A_Total",
    "PAQ_C-PAQ_C_Total",
    "PCIAT-PCIAT_01",
    "PCIAT-PCIAT_02",
    "PCIAT-PCIAT_03",
    "PCIAT-PCIAT_04",
    "PCIAT-PCIAT_05",
    "PCIAT-PCIAT_06",
    "PCIAT-PCIAT_07",
    "PCIAT-PCIAT_08",
    "PCIAT-PCIAT_09",
    "PCIAT-PCIAT_10",
    "PCIAT-PCIAT_11",
    "PCIAT-PCIAT_12",
    "PCIAT-PCIAT_13",
    "PCIAT-PCIAT_14",
    "PCIAT-PCIAT_15",
    "PCIAT-PCIAT_16",
    "PCIAT-PCIAT_17",
    "PCIAT-PCIAT_18",
    "PCIAT-PCIAT_19",
    "PCIAT-PCIAT_20",
    "PCIAT-PCIAT_Total",
    "SDS-SDS_Total_Raw",
    "SDS-SDS_Total_T",
    "PreInt_EduHx-computerinternet_hoursday",
)

# The study's categorical columns, in dictionary order.
CATEGORICAL = (
    "Basic_Demos-Enroll_Season",
    "Basic_Demos-Sex",
    "CGAS-Season",
    "Physical-Season",
    "Fitness_Endurance-Season",
    "FGC-Season",
    "BIA-Season",
    "PAQ_A-Season",
    "PAQ_C-Season",
    "PCIAT-Season",
    "SDS-Season",
)


@dataclass(frozen=True)
class CohortSpec:
    """Names of the cohort columns; defaults are the study's own column names."""

    numeric: tuple[str, ...] = NUMERIC
    categorical: tuple[str, ...] = CATEGORICAL
    target: str = "sii"
    key: str = "id"
    age: str = "Basic_Demos-Age"
    sex: str = "Basic_Demos-Sex"
    function_score: str = "CGAS-CGAS_Score"
    bmi: str = "Physical-BMI"
    total: str = "PCIAT-PCIAT_Total"
    hours: str = "PreInt_EduHx-computerinternet_hoursday"
    items: tuple[str, ...] = tuple(f"PCIAT-PCIAT_{i:02d}" for i in range(1, 21))
    season_pattern: str = "Season"
    # 0 = Male, 1 = Female per the study's data dictionary.
    sex_labels: dict[float, str] = field(default_factory=lambda: {0.0: "Male", 1.0: "Female"})

    @property
    def leaky(self) -> tuple[str, ...]:
        """Columns the target is computed from; they must not be model inputs."""
        return (self.total, *self.items)

    @property
    def seasons(self) -> tuple[str, ...]:
        return tuple(c for c in self.categorical if self.season_pattern.lower() in c.lower())

    def schema(self) -> StructType:
        """Declared types for a typed CSV read: measures are doubles, seasons are strings."""
        text = set(self.categorical) - {self.sex}
        names = [self.key, *dict.fromkeys([*self.numeric, *self.categorical]), self.target]
        return StructType(
            [StructField(n, StringType() if n == self.key or n in text else DoubleType()) for n in names]
        )


AGGREGATED_FEATURES_SCHEMA = StructType(
    [StructField("id", StringType(), False)]
    + [
        StructField(f"{measure}_{stat}", DoubleType())
        for measure in ("X", "Y", "Z", "enmo", "light")
        for stat in ("mean", "std", "max", "min")
    ]
    + [StructField("battery_voltage_mean", DoubleType())]
)
