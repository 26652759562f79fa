"""Attribute files of made repositories, one for each of a few ecosystems: what their owners usually declare.

Every ecosystem has two repositories with the same lines: one declares them at its root,
the other in the directory of its application, where they hold below it alone. A pattern
that both declare carries over to repositories that declare nothing (see handwritten).
"""

from __future__ import annotations

APPLICATION = "packages/app"

# fixed values: lines of attribute files
LINES = {
    "web": """
vendor/** linguist-vendored
node_modules/** linguist-vendored
bower_components/** linguist-vendored
jspm_packages/** linguist-vendored
.yarn/** linguist-vendored
*-[0-9]*.[0-9]*.[0-9]*.js linguist-vendored
*-[0-9]*.[0-9]*.[0-9]*.css linguist-vendored
jquery*.js linguist-vendored
bootstrap.css linguist-vendored
bootstrap.js linguist-vendored
*.min.* linguist-generated
*-min.js linguist-generated
*-min.css linguist-generated
*.map linguist-generated
*.bundle.js linguist-generated
*.bundle.css linguist-generated
*.chunk.js linguist-generated
*.chunk.css linguist-generated
*.umd.js linguist-generated
*.iife.js linguist-generated
dist/** linguist-generated
.next/** linguist-generated
.nuxt/** linguist-generated
build/static/** linguist-generated
out/**/*.d.ts linguist-generated
coverage/lcov-report/** linguist-generated
lcov-report/** linguist-generated
generated/** linguist-generated
__generated__/** linguist-generated
__snapshots__/** linguist-generated
*.snap linguist-generated
*_pb.js linguist-generated
*_pb.d.ts linguist-generated
*_grpc_pb.js linguist-generated
*.gen.ts linguist-generated
yarn.lock linguist-generated
package-lock.json linguist-generated
npm-shrinkwrap.json linguist-generated
pnpm-lock.yaml linguist-generated
""",
    "python": """
vendored/** linguist-vendored
_vendor/** linguist-vendored
site-packages/** linguist-vendored
dist-packages/** linguist-vendored
.venv/** linguist-vendored
swagger_client/** linguist-generated
openapi_client/** linguist-generated
*_pb2.py linguist-generated
*_pb2.pyi linguist-generated
*_pb2_grpc.py linguist-generated
parsetab.py linguist-generated
*_rc.py linguist-generated
poetry.lock linguist-generated
Pipfile.lock linguist-generated
""",
    "go": """
vendor/** linguist-vendored
third_party/** linguist-vendored
Godeps/** linguist-vendored
generated/** linguist-generated
gen/proto/** linguist-generated
*.pb.go linguist-generated
*.pb.gw.go linguist-generated
zz_generated.* linguist-generated
*_gen.go linguist-generated
*_string.go linguist-generated
*.gen.go linguist-generated
mock_*_gen.go linguist-generated
bindata.go linguist-generated
go.sum linguist-generated
""",
    "native": """
third_party/** linguist-vendored
third-party/** linguist-vendored
thirdparty/** linguist-vendored
3rdparty/** linguist-vendored
extern/** linguist-vendored
external/*/** linguist-vendored
externals/** linguist-vendored
Godeps/** linguist-vendored
subprojects/*-[0-9]*.[0-9]*/** linguist-vendored
deps/*-[0-9]*.[0-9]*/** linguist-vendored
libs/*-[0-9]*.[0-9]*/** linguist-vendored
lib/*-[0-9]*.[0-9]*/** linguist-vendored
*.pb.h linguist-generated
*.pb.cc linguist-generated
lex.*.c linguist-generated
lex.yy.c linguist-generated
*.tab.c linguist-generated
*.tab.h linguist-generated
*.tab.cc linguist-generated
moc_*.cpp linguist-generated
moc_*.cc linguist-generated
ui_*.h linguist-generated
qrc_*.cpp linguist-generated
Cargo.lock linguist-generated
flake.lock linguist-generated
""",
    "apps": """
vendor/** linguist-vendored
Pods/** linguist-vendored
Carthage/Checkouts/** linguist-vendored
target/classes/** linguist-generated
target/generated-sources/** linguist-generated
generated-sources/** linguist-generated
generated/** linguist-generated
autogen/** linguist-generated
swagger_client/** linguist-generated
openapi_client/** linguist-generated
*.pb.swift linguist-generated
*.generated.* linguist-generated
*_generated.* linguist-generated
*.Designer.cs linguist-generated
*.g.cs linguist-generated
*.g.i.cs linguist-generated
*.g.dart linguist-generated
*.freezed.dart linguist-generated
Gemfile.lock linguist-generated
composer.lock linguist-generated
""",
}
# the owners' word on a folder of their own below a vendored one: a deeper file outranks the one above
OWN_WORK = ("vendor/ours", "** -linguist-vendored\n")


def attribute_rows() -> list[tuple[str, str, str]]:
    """(repo, dir, content) of the attribute files."""
    rows = [(f"{name}/{place or 'root'}", place, content) for name, content in LINES.items() for place in ("", APPLICATION)]
    return [*rows, (f"go/{APPLICATION}", *OWN_WORK)]
