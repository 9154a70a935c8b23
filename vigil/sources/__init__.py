"""Where tables come from and where results go: resolvers, JDBC, sinks, the shared folder."""
