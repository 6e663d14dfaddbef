"""Named queries over the sample tables, each with an equivalent SQL text where one exists."""
