"""Entry points that chain the operators of one business process."""
