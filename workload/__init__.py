"""The operators run over the driver's tables: adapter, registered queries, oracle SQL, benchmark."""
