"""A small document tree on the standard library's HTML parser: the brute force that the
regular expressions are held against."""

from html.parser import HTMLParser

VOID = {"br", "img", "input", "hr", "meta", "link"}


class Node:
    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent, self.children = tag, dict(attrs), parent, []

    def walk(self):
        for child in self.children:
            if isinstance(child, Node):
                yield child
                yield from child.walk()

    def find_all(self, tag, token=None):
        return [
            n
            for n in self.walk()
            if n.tag == tag and (token is None or token in (n.attrs.get("class") or "").split())
        ]

    def find(self, tag, token=None):
        return next(iter(self.find_all(tag, token)), None)

    def strings(self):
        for child in self.children:
            if isinstance(child, Node):
                if child.tag not in ("script", "style"):
                    yield from child.strings()
            else:
                yield child

    def text(self, joiner=""):
        return joiner.join(s.strip() for s in self.strings() if s.strip())


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("root", [], None)

    def handle_starttag(self, tag, attrs):
        node = Node(tag, attrs, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, attrs, self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html):
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root
