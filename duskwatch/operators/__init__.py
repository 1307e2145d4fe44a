"""DataFrame -> DataFrame operators.  All of them are lazy: none runs a Spark job."""
