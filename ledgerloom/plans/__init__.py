"""The shared test tables in the shapes of the stored ones, and the queries over them."""
