"""How operators are put together: sized joins, the composite flows, the query registry."""
