"""Every operator as a query over the supplied tables, with SQL to compare against."""
