"""Public licence texts and notices that operator 6 knows by default: (licence, text). Pass a table of your own for more."""

MIT = """MIT License
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

ISC = """ISC License
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_TAIL = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
_BSD_1 = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BSD_2 = "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."

ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""

APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""

KNOWN = [
    ("MIT", MIT),
    ("MIT", MIT.split("\n", 1)[1]),
    ("ISC", ISC),
    ("ISC", ISC.split("\n", 1)[1]),
    ("BSD-2-Clause", "\n".join([_BSD_HEAD, _BSD_1, _BSD_2, _BSD_TAIL])),
    ("BSD-3-Clause", "\n".join([_BSD_HEAD, _BSD_1, _BSD_2, _BSD_3, _BSD_TAIL])),
    ("Zlib", ZLIB),
    ("Apache-2.0", APACHE_HEADER),
    # one-line notices
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]

#: Digests of the canonical forms of further public licence texts: whole texts as they are shipped with software, with and without titles and appendices.
#: (license, SHA-256 of canonical text); a text of your own gets its digest by license_scan.known_digests.
DIGESTS = [
    ("0BSD", "25a274d52b3014d9bd64e0f3362fd279ac1655f163d5c518f6b9f6c43354802c"),
    ("Apache-2.0", "3881ce8900fc15e18dfdd4e48104cb2ad0984afa2b43d0b876fbbb8384bb7283"),
    ("Apache-2.0", "5a6c301be78b6eeda425e1f7502349752a4aa3781a6a5115b23270d989330bd7"),
    ("Apache-2.0", "7570479f2aa55017b17f96b642a702c3f915816adb62399466ff9d6a37c67c98"),
    ("Apache-2.0", "896e039a03d5a73c43dc5e75ad8ea1a906a3ffd70d9843611426dca7a0a2aadf"),
    ("Apache-2.0", "c40235f98e8998f2e4f5fc5131b16fb3c6c5f8ce252d3e6e08daf233725c2073"),
    ("Apache-2.0", "d93b6a13d99dd2f1883cfd01faecc4ef05eb419161fbe40dda09dcb074d43330"),
    ("Apache-2.0", "dfb11198400532b4f305d6de1101f4a4c4fb6ca0cf69686b401f9c97e428b15d"),
    ("Artistic-1.0-Perl", "d1ce9579b2c8d32b706b421d9c42208152298e00849e57ce7da8e906ed3802f2"),
    ("BSD-2-Clause", "1a346ec500e0e2a3b0635130743cb752397c1ab0a453dea1a45bea5bc6eaa44a"),
    ("BSD-2-Clause", "7be8178e4e9d0dea6ff4b04bd52bd086d7ea8386a5a6e09760df916bae5d42d2"),
    ("BSD-2-Clause", "986c3c3199a93b916c8f2e0aeed57819bcbdcb2cd9d99902dcc9d74b53f93a74"),
    ("BSD-2-Clause", "a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30"),
    ("BSD-2-Clause", "e36c57c376f1fac8945922863988e22c5e7460394aeb78fafeceef531dac4870"),
    ("BSD-3-Clause", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),
    ("BSD-3-Clause", "526279aa5ce65fb23ffd45ae5430abc95af7bd6118ff94cc2842185ce6aa2c02"),
    ("BSD-3-Clause", "53075742228962c7ea381b8242c64602fa32e7b8f52facb6d13ee4f9c596ddfa"),
    ("BSD-3-Clause", "9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2"),
    ("BSD-3-Clause", "cc65957a28f15bbcef5b0c23770aae3bd8462cb25904250f77a812ab3b2efe15"),
    ("BSD-3-Clause", "f94931e221f919e6cec5ca99e0ea7da1912b2c7d805cdaee8baf508c248bc1af"),
    ("BlueOak-1.0.0", "a9c55a1f11761d3902de154cbb4cb5e8a154ebc12ae88944c0b7a5a969b6ec47"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2-only", "890d36e662cb09f33113b55d7d1c753ddc4b0ead994791dfdbdaf4349bb51e36"),
    ("GFDL-1.3-only", "ade5f7440f9cc494ee9b2d9d76ef9d5e7528b55ddcc78de4bc94bea8a66d4e50"),
    ("GPL-1.0-only", "5928867c4816d4fe58d14fa559bbf42db7737259a8fa2c199ab4cc85c08febad"),
    ("GPL-2.0-only", "3590e6efa091629fd2f63a945979df2b0e351a9212a999210cc754de77576825"),
    ("GPL-3.0-only", "357785dfc8374a5fa34bcb32473003e42a01742fd3555845b700b5aca0261368"),
    ("GPL-3.0-only", "890cebe3ae5212c2a063155944f898ec9e8155f68610871ad4d7b3cdc7e78d6a"),
    ("ISC", "0afd3b319501518319787836e8bac829e7aa752d1ac129c3e5e94f53007ab195"),
    ("ISC", "217da0747cec63a2e734185db11cbaa819bcd9e5b83cd12f812128fffe66e26a"),
    ("ISC", "23651ce8a73abaa8fad9143faad3fca843b5de6baf345008f65c453ea5685fb1"),
    ("ISC", "2b614fb2c18253fb7c1d5d24276593e12d81b854b5e79442a26885adc7ddc0c0"),
    ("ISC", "40e6eb51c3b409d93549806b55b249c261dab149d19b56cc163624f39a08b1db"),
    ("ISC", "4407eb89dd3b0fb495b4681ddb0526c6aa98fdc9db3bfc4706579b2504e26fcd"),
    ("ISC", "5fb628af212d6618ceee2210c60a5dee79b64f7c54d6cb2c7b40f19369024708"),
    ("LGPL-2.0-only", "433a23e3de4c61d63a7cd44b933fd6eec329aee37d661739c41cbd8b38b8c6db"),
    ("LGPL-2.1-only", "a39c86f886ec9c24ccb5d6e5f9218d2e1a091f8a1d18a8722ac6f9c8c93ad93f"),
    ("LGPL-3.0-only", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MIT", "0cf21bdfd1964a97a8615e128534845826afbc887edc95aa5c925cbf64386b5c"),
    ("MIT", "35a446201226de6b27cfb7106d0f6c697f63bfeac2913dcf89024911e66ef164"),
    ("MIT", "6733127d88b7d3bd59c42da120690dbdff1e658acf3fa3e2448092079ad6999a"),
    ("MIT", "6ad3654379e72bbdf8478d5c90fb1e2525aba033fbe675e0ef2248aac67c0f6f"),
    ("MIT", "6c833965e9ca4cf8095655005226f24fe8bf7b1605dbe513204837a7371fa127"),
    ("MPL-1.1", "e0ef9dbd531e1144276348572887b7d756d42277c948f3a4f9d02d4634742d16"),
    ("MPL-2.0", "4019e4c8fe9ede57c538b37b3332dc097a88c163e273bb6905d38316e63c2eb6"),
    ("Python-2.0", "76735e9bf99255f269d39552722bd2fb6b7af62725e0fb38cb8a9ca9d548d66f"),
    ("Python-2.0", "bcfb241f2f8d2be279b80c3bdfc79e12a2fe0185938f783a877a69f19748fc97"),
    ("Python-2.0", "f82d93349f4f0e1d7f2c87bebb3d4cb39cb2450ff5dbe34f2bef30e9ad651257"),
    ("Unlicense", "fd1b07be5f4f94926b6ea4df3943b05ab90c1a1f3b1a3d574ae7ab58bca58fff"),
    ("Zlib", "1b8c5cd52eceb19ab0bc3cb40be110b1c0e7fa2671a3fe5866e59dd1502e69c7"),
]
