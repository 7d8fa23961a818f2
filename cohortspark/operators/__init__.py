"""DataFrame -> DataFrame operators. Anything that learns has a fit step and a transform step."""
