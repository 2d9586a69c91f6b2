"""Message sources: a topic, or a folder of files with the same columns where no broker connector is installed."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from siftlake.schemas import MESSAGE_SCHEMA

# Fixed value: the offsets per micro-batch of the demonstration set-up. It suits a few events per second only, so the
# sources below are unlimited unless a limit is given.
DEMO_OFFSETS_PER_TRIGGER = 100


@dataclass(frozen=True)
class KafkaTopic:
    """One topic from its earliest offset, tolerating offsets that the broker has already removed."""

    servers: str
    topic: str
    starting_offsets: str = "earliest"
    fail_on_data_loss: bool = False
    max_per_trigger: int | None = None
    extra: dict[str, str] = field(default_factory=dict)

    def options(self, streaming: bool) -> dict[str, str]:
        options = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.topic,
            "startingOffsets": self.starting_offsets,
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
        }
        if streaming and self.max_per_trigger is not None:
            options["maxOffsetsPerTrigger"] = str(self.max_per_trigger)
        return options | self.extra

    def stream(self, spark: SparkSession) -> DataFrame:
        return spark.readStream.format("kafka").options(**self.options(streaming=True)).load()

    def batch(self, spark: SparkSession) -> DataFrame:
        return spark.read.format("kafka").options(**self.options(streaming=False)).load()


@dataclass(frozen=True)
class MessageFiles:
    """Parquet files of ``partition, offset, value`` rows; every file is read once per checkpoint."""

    path: str
    max_per_trigger: int | None = None

    def stream(self, spark: SparkSession) -> DataFrame:
        reader = spark.readStream.schema(MESSAGE_SCHEMA)
        if self.max_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", self.max_per_trigger)
        return reader.parquet(self.path)

    def batch(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(MESSAGE_SCHEMA).parquet(self.path)


MessageSource = KafkaTopic | MessageFiles
