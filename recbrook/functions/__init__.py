"""Column functions: built-in Spark expressions (JVM side, codegen'd),
plus one Arrow-batched UDF for WKB point decoding."""
