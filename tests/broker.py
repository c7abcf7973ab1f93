"""A stand-in for a broker in tests: topics as files, offsets by a partition's lines."""

import json
import os
import uuid

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

SCHEMA = "key binary, value binary, topic string, partition int, offset bigint"


class Broker(DataSource):
    @classmethod
    def name(cls):
        return "broker"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return Reader(self.options)

    def writer(self, schema, overwrite):
        return Writer(self.options, schema.names)


class Reader(DataSourceReader):
    def __init__(self, options):
        self.folder = os.path.join(options["kafka.bootstrap.servers"], options["subscribe"])

    def partitions(self):
        return [InputPartition(int(p)) for p in sorted(os.listdir(self.folder))]

    def read(self, partition):
        folder = os.path.join(self.folder, str(partition.value))
        offset = 0
        for name in sorted(os.listdir(folder)):
            with open(os.path.join(folder, name)) as f:
                for line in f:
                    yield (None, json.loads(line).encode(), os.path.basename(self.folder), partition.value, offset)
                    offset += 1


class Writer(DataSourceWriter):
    def __init__(self, options, names):
        self.folder = os.path.join(options["kafka.bootstrap.servers"], options["topic"])
        self.names = names

    def write(self, rows):
        files = {}
        for i, row in enumerate(rows):
            values = dict(zip(self.names, row))
            partition = values.get("partition", i % 3)
            if partition not in files:
                folder = os.path.join(self.folder, str(partition))
                os.makedirs(folder, exist_ok=True)
                files[partition] = open(os.path.join(folder, uuid.uuid4().hex), "w")
            files[partition].write(json.dumps(values["value"]) + "\n")
        for f in files.values():
            f.close()
        return WriterCommitMessage()
