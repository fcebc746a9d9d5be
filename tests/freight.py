"""A message type for lines of orders, with a field of every kind, built without a compiler."""

from google.protobuf import descriptor_pb2, descriptor_pool, message_factory, timestamp_pb2

Kind = descriptor_pb2.FieldDescriptorProto
ONE, MANY = Kind.LABEL_OPTIONAL, Kind.LABEL_REPEATED

LINE = [
    (2, "order_key", Kind.TYPE_INT64, ONE, ""),
    (4, "line_number", Kind.TYPE_UINT32, ONE, ""),
    (6, "price", Kind.TYPE_DOUBLE, ONE, ""),
    (8, "tax", Kind.TYPE_FLOAT, ONE, ""),
    (10, "returned", Kind.TYPE_BOOL, ONE, ""),
    (12, "seal", Kind.TYPE_BYTES, ONE, ""),
    (14, "days_late", Kind.TYPE_SINT32, ONE, ""),
    (16, "fingerprint", Kind.TYPE_UINT64, ONE, ""),
    (18, "note", Kind.TYPE_STRING, ONE, ""),
    (20, "carrier", Kind.TYPE_ENUM, ONE, ".freight.Carrier"),
    (22, "stamps", Kind.TYPE_STRING, MANY, ""),
    (24, "loads", Kind.TYPE_INT64, MANY, ""),
    (26, "port", Kind.TYPE_MESSAGE, ONE, ".freight.Port"),
    (28, "papers", Kind.TYPE_MESSAGE, MANY, ".freight.Line.PapersEntry"),
    (30, "shipped", Kind.TYPE_MESSAGE, ONE, ".google.protobuf.Timestamp"),
]


def fill(message, fields):
    for number, name, kind, label, of in fields:
        message.field.add(number=number, name=name, type=kind, label=label, type_name=of or None)


def descriptor_set() -> bytes:
    file = descriptor_pb2.FileDescriptorProto(
        name="freight.proto", package="freight", syntax="proto3", dependency=["google/protobuf/timestamp.proto"]
    )
    carrier = file.enum_type.add(name="Carrier")
    for number, name in enumerate(("ROAD", "RAIL", "SEA", "AIR")):
        carrier.value.add(number=number, name=name)
    line = file.message_type.add(name="Line")
    fill(line, LINE)
    papers = line.nested_type.add(name="PapersEntry")
    papers.options.map_entry = True
    fill(papers, [(1, "key", Kind.TYPE_INT32, ONE, ""), (2, "value", Kind.TYPE_BYTES, ONE, "")])
    fill(file.message_type.add(name="Port"), [(1, "country", Kind.TYPE_STRING, ONE, ""), (2, "distance", Kind.TYPE_DOUBLE, ONE, "")])
    fill(file.message_type.add(name="Crate"), [(1, "content", Kind.TYPE_MESSAGE, ONE, ".freight.Crate")])
    times = descriptor_pb2.FileDescriptorProto()
    timestamp_pb2.DESCRIPTOR.CopyToProto(times)
    return descriptor_pb2.FileDescriptorSet(file=[times, file]).SerializeToString()


def message_class(name: str):
    pool = descriptor_pool.DescriptorPool()
    for file in descriptor_pb2.FileDescriptorSet.FromString(descriptor_set()).file:
        pool.Add(file)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName(name))
