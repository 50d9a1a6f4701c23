"""DataFrame-to-DataFrame steps; all of them build on built-in expressions only."""
